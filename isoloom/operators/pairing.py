"""From a list of read files to a sample sheet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoloom.functions.names import illumina_sample_id, mate_role, nanopore_sample_id

# Column order of the two sheet layouts.
SHEET_COLUMNS = {
    "gva": (
        "CODIGO_MUESTRA_ORIGEN", "PETICION", "FECHA_TOMA_MUESTRA", "ESPECIE_SECUENCIA", "MOTIVO_WGS", "NUM_BROTE",
        "CONFIRMACION", "COMENTARIO_WGS", "ILLUMINA_R1", "ILLUMINA_R2", "NANOPORE",
    ),
    "normal": ("id", "collection_date", "organism", "illumina_r1", "illumina_r2", "nanopore"),
}


def _last(value: Column) -> Column:
    """Of several files for one place the last listed wins: later extension first, then path."""
    return F.max(F.when(value, F.struct("ext_rank", "path")))["path"]


def paired_mates(files: DataFrame) -> DataFrame:
    """``sample, r1, r2`` from ``path, ext_rank``; files whose mate cannot be told are left out."""
    named = files.select(
        illumina_sample_id(F.col("path")).alias("sample"), mate_role(F.col("path")).alias("mate"), "ext_rank", "path"
    ).filter(F.col("mate").isNotNull())
    return named.groupBy("sample").agg(
        _last(F.col("mate") == "R1").alias("r1"), _last(F.col("mate") == "R2").alias("r2")
    )


def incomplete_pairs(pairs: DataFrame) -> DataFrame:
    """Samples that lack a mate, and which one."""
    lacking = F.concat_ws(",", F.when(F.col("r1").isNull(), "R1"), F.when(F.col("r2").isNull(), "R2"))
    return pairs.filter(F.col("r1").isNull() | F.col("r2").isNull()).select("sample", lacking.alias("missing"))


def long_read_files(files: DataFrame) -> DataFrame:
    """``sample, nanopore``: one file per sample, the last listed wins."""
    named = files.withColumn("sample", nanopore_sample_id(F.col("path")))
    return named.groupBy("sample").agg(_last(F.lit(True)).alias("nanopore"))


def sheet_template(samples: DataFrame, mode: str) -> DataFrame:
    """Sheet with ids and read paths filled in, all else blank. Columns r1, r2, nanopore are used where present."""
    names = SHEET_COLUMNS[mode]
    filled = {names[0]: "sample"}
    filled.update({c: src for c in names for src in ("r1", "r2") if c.lower() == f"illumina_{src}"})
    filled.update({c: "nanopore" for c in names if c.lower() == "nanopore"})
    return samples.select(
        *[F.coalesce(filled[c], F.lit("")).alias(c) if filled.get(c) in samples.columns else F.lit("").alias(c) for c in names]
    )
