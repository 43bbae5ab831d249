"""Laboratory report: sheet and results joined, renamed and completed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoloom.functions.names import deposit_path, sequencing_method

# Result columns left out, and laboratory names of the columns that stay.
DROPPED = ("SCOPE_core", "GENE_resfinder", "PHENO_resfinder", "MLST")
LAB_NAMES = {
    "id": "CODIGO_MUESTRA_ORIGEN",
    "id2": "PETICION",
    "collection_date": "FECHA_TOMA_MUESTRA",
    "organism": "ESPECIE_SECUENCIA",
    "relevance": "MOTIVO_WGS",
    "illumina_r1": "ILLUMINA_R1",
    "illumina_r2": "ILLUMINA_R2",
    "nanopore": "NANOPORE",
    "Scheme_mlst": "ID_WS",
    "ST": "ST_WGS",
    "MLST": "MLST_WGS",
    "AMR": "R_Geno_WGS",
    "PHENO_resfinder": "PHENO_WGS",
    "VIRULENCE": "V_WGS",
    "confirmation_note": "CONFIRMACION",
    "outbreak_id": "NUM_BROTE",
    "comment": "COMENTARIO_WGS",
}


RESULT_COLUMNS = ("Scheme_mlst", "ST", "MLST", "AMR", "VIRULENCE", "PHENO_resfinder")


def paired_only(sheet: DataFrame) -> DataFrame:
    """Samples with a second mate: those that are assembled and typed."""
    return sheet.filter(F.col("illumina_r2").isNotNull())


def detect_join_key(sheet: DataFrame, report: DataFrame) -> DataFrame:
    """One row, ``join_key``: ``id`` if it covers every reported sample, else ``id2``, else null.

    Both tests run over the distinct samples in one aggregate.
    """
    samples = report.select("Sample").distinct()
    for name in ("id", "id2"):
        keys = sheet.select(F.col(name).alias("Sample")).filter("Sample IS NOT NULL").distinct()
        samples = samples.join(keys.withColumn(f"in_{name}", F.lit(True)), "Sample", "left")
    held = samples.agg(*[F.bool_and(F.coalesce(f"in_{n}", F.lit(False))).alias(n) for n in ("id", "id2")])
    all_in = lambda n: F.coalesce(F.col(n), F.lit(True))
    return held.select(F.when(all_in("id"), "id").when(all_in("id2"), "id2").alias("join_key"))


def _prefilled(sheet: DataFrame) -> DataFrame:
    """Typing columns that a sheet brings along, under their internal or laboratory names in any case, renamed to
    ``sheet_<laboratory name>``, so that they can't be mistaken for results."""
    lab_names = {inner.lower(): lab for inner, lab in LAB_NAMES.items() if inner in RESULT_COLUMNS}
    lab_names |= {lab.lower(): lab for lab in lab_names.values()} | {"scope_core": "SCOPE_core", "gene_resfinder": "GENE_resfinder"}
    return sheet.withColumnsRenamed({c: f"sheet_{lab_names[c.lower()]}" for c in sheet.columns if c.lower() in lab_names})


def lab_join(sheet: DataFrame, report: DataFrame, key: str) -> DataFrame:
    """Sheet rows with their results; samples without results stay. Typing columns of the sheet are set apart."""
    return _prefilled(sheet).join(report.withColumnRenamed("Sample", key), key, "left")


def lab_projection(joined: DataFrame, run: Column, keep_typing: bool = False) -> DataFrame:
    """Laboratory columns. A result wins over what the sheet holds already; the sheet's value fills a missing one.
    ``keep_typing`` also keeps the allele and phenotype texts."""
    left_out = {c for c in DROPPED if not (keep_typing and c in ("MLST", "PHENO_resfinder"))}
    fixed = {
        "CARRERA": run, "MO_EST_WGS": F.lit("BACTERIA"), "TIPO_ANALISIS_WGS": F.lit("VERIFICACION"),
        "PLASMIDOS_WGS": F.lit(None).cast("string"),
    }
    taken = {name.lower() for name in fixed}
    out = []
    for name in joined.columns:
        if name in left_out or name.startswith("sheet_") or name.lower() in taken:
            continue
        lab, value = LAB_NAMES.get(name, name), F.col(f"`{name}`")
        if f"sheet_{lab}" in joined.columns:
            value = F.coalesce(value, F.col(f"sheet_{lab}"))
        out.append(value.alias(lab))
    return joined.select(*out, *[value.alias(name) for name, value in fixed.items()])


def lab_report(sheet: DataFrame, report: DataFrame, key: str, run: Column, store: str, keep_typing: bool = False) -> DataFrame:
    table = lab_projection(lab_join(sheet, report, key), run, keep_typing)
    first, long_reads = F.col("ILLUMINA_R1"), F.col("NANOPORE")
    table = table.withColumn("OBS_MET_WGS", sequencing_method((first,), long_reads))
    path = deposit_path(store, F.col("CARRERA"), F.col("OBS_MET_WGS"), first, long_reads)
    return table.withColumn("FICHERO_LECTURAS_WGS", path)


def lab_report_auto(sheet: DataFrame, report: DataFrame, run: Column, store: str) -> DataFrame:
    """As ``lab_report`` with the join column found from the data."""
    key = detect_join_key(sheet, report).first()["join_key"]
    if key is None:
        raise ValueError("reported samples are found neither in id nor in id2")
    return lab_report(sheet, report, key, run, store)
