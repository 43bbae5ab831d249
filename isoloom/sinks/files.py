"""Text and table outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoloom.operators.summary import REPORT_COLUMNS, report_sort


def _as_text(df: DataFrame) -> DataFrame:
    """List columns become texts joined by spaces."""
    return df.select(*[F.concat_ws(" ", c).alias(c) if t.startswith("array") else F.col(f"`{c}`") for c, t in df.dtypes])


def _by_folder(df: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """Rows of a folder come together, so it gets few files; a folder with very many rows is split at run time."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_delimited(df: DataFrame, path: str, sep: str, partition_by: tuple[str, ...] = ()) -> None:
    writer = _by_folder(_as_text(df), partition_by).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    # cells are written as they are: blanks kept, empty texts without quotes
    writer.csv(
        path, sep=sep, header=True, emptyValue="", nullValue="", escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def write_validated(sheet: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Validated sheet, always separated by semicolons, as later steps expect; helper columns stay out of it."""
    helpers = [c for c in ("row_no", "sheet", "run") if c not in partition_by]
    write_delimited(sheet.drop(*helpers), path, ";", partition_by)


def write_report_tsv(report: DataFrame, path: str) -> None:
    """Combined report in order of sample and type; the part files follow that order."""
    write_delimited(report_sort(report.select(*REPORT_COLUMNS)), path, "\t")


def write_lab_csv(table: DataFrame, path: str) -> None:
    write_delimited(table, path, ";")


def write_validation_report(lines: DataFrame, path: str) -> None:
    """Report text, one folder per sheet; lines of a sheet are sorted across the cluster."""
    ordered = lines.repartitionByRange("sheet", "section", "check", "row_no", "line").sortWithinPartitions(
        "sheet", "section", "check", "row_no", "line"
    )
    ordered.select("sheet", F.col("line").alias("value")).write.mode("overwrite").partitionBy("sheet").text(path)


def manifest_lines(files: DataFrame) -> DataFrame:
    """``md5  relative path`` per file."""
    return files.select(F.concat_ws("  ", "md5", "rel_path").alias("value"))


def write_manifest(files: DataFrame, path: str) -> None:
    manifest_lines(files).write.mode("overwrite").text(path)


def write_qc_metrics(metrics: DataFrame, path: str) -> None:
    """Long metric table, one folder per stage."""
    _by_folder(metrics, ("stage",)).write.mode("overwrite").partitionBy("stage").parquet(path)


def write_fastq(reads: DataFrame, path: str, partition_by: tuple[str, ...] = (), compression: str = "gzip") -> None:
    """Four lines per read."""
    record = F.concat_ws("\n", F.concat(F.lit("@"), "read_id"), "seq", F.lit("+"), "qual")
    lines = _by_folder(reads.select(*partition_by, record.alias("value")), partition_by)
    writer = lines.write.mode("overwrite").option("compression", compression)
    (writer.partitionBy(*partition_by) if partition_by else writer).text(path)


def write_fasta(records: DataFrame, path: str, partition_by: tuple[str, ...] = (), width: int = 60) -> None:
    wrapped = F.regexp_replace("seq", f"(.{{{width}}})(?=.)", "$1\n")
    record = F.concat(F.lit(">"), "id", F.lit("\n"), wrapped)
    writer = _by_folder(records.select(*partition_by, record.alias("value")), partition_by).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).text(path)
