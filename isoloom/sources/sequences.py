"""FASTQ reads and FASTA contigs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoloom.session import with_computed
from isoloom.sources.lines import edge_lines, numbered_lines, placed_lines

READ_SCHEMA = "file string, read_id string, seq string, qual string"
PACKED = r"file rlike '(?i)[.](gz|bz2|zst|lz4|snappy|deflate)$'"  # files that Spark unpacks and can't split


def _checked(file: str, lines: pa.Array) -> list[pa.Array]:
    """The first, second and fourth lines of whole records; anything else than records or blank lines is an error."""
    names, seqs, marks, quals = (lines.take(pa.array(np.arange(first, len(lines), 4))) for first in range(4))
    seqs, quals = (pc.utf8_rtrim(column, "\r") for column in (seqs, quals))
    right = pc.and_(pc.and_(pc.starts_with(names, "@"), pc.starts_with(marks, "+")), pc.equal(pc.utf8_length(seqs), pc.utf8_length(quals)))
    if not pc.all(right).as_py():
        blank = pc.equal(pc.utf8_trim_whitespace(pc.binary_join_element_wise(names, seqs, marks, quals, "")), "")
        if not pc.all(pc.or_(right, blank)).as_py():
            raise ValueError(f"{file} holds lines that are no FASTQ records")
        names, seqs, quals = (column.filter(right) for column in (names, seqs, quals))
    return [names, seqs, quals]


def _check_rest(place: tuple | None, lines: pa.Array | None) -> None:
    if lines is not None and any(v.strip() for v in lines.to_pylist()):
        raise ValueError(f"{place[0]} ends within a FASTQ record")


def _records(batches: Iterator[pa.RecordBatch], whole_files: bool) -> Iterator[pa.RecordBatch]:
    """Put four consecutive lines of one split together; lines left open are carried to the next batch. The lines of a
    record that began in an earlier split (``skip``), or goes on in a later one, are left to ``edge_lines``."""
    place, left, skip = None, None, 0
    for batch in batches:
        files, lines = batch.column("file"), batch.column("value")
        if not len(lines):
            continue
        blocks, skips = batch.column("block").to_numpy(), batch.column("skip").to_numpy()
        codes = files.dictionary_encode().indices.to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(codes) | np.diff(blocks)) + 1).tolist(), len(codes)]
        for begin, end in zip(cuts, cuts[1:]):
            here, part = (files[begin].as_py(), int(blocks[begin])), lines.slice(begin, end - begin)
            if here == place:
                part = pa.concat_arrays([left, part])
            else:
                if whole_files:
                    _check_rest(place, left)
                skip = int(skips[begin])
            part, skip = part.slice(min(skip, len(part))), max(skip - len(part), 0)
            whole = len(part) // 4 * 4
            place, left = here, part.slice(whole)
            if whole:
                names, seqs, quals = _checked(here[0], part.slice(0, whole))
                source = pa.array([here[0]] * len(names), pa.string())
                yield pa.RecordBatch.from_arrays([source, names, seqs, quals], ["file", "read_id", "seq", "qual"])
    if whole_files:
        _check_rest(place, left)


def _grouped(lines: DataFrame) -> DataFrame:
    """Records from numbered lines of any order. The check is a filter, so it holds whatever columns are asked for."""
    place = (F.col("line_no") - 1) % 4
    record = F.expr("(line_no - 1) div 4").alias("record")
    pick = lambda i, name: F.max(F.when(place == i, F.regexp_replace("value", "\r$", ""))).alias(name)
    grouped = lines.groupBy("file", record).agg(pick(0, "read_id"), pick(1, "seq"), pick(2, "mark"), pick(3, "qual"))
    blank = F.trim(F.concat_ws("", "read_id", "seq", "mark", "qual")) == ""
    right = F.col("read_id").startswith("@") & F.col("mark").startswith("+") & (F.length("seq") == F.length("qual"))
    wrong = F.concat(F.lit("no FASTQ record: file "), "file", F.lit(", record "), F.col("record").cast("string"))
    kept = F.when(blank, False).when(right, True).otherwise(F.raise_error(wrong).cast("boolean"))
    return grouped.where(kept).select("file", "read_id", "seq", "qual")


def _tidy(reads: DataFrame) -> DataFrame:
    """Without the leading @ and without line ends of other systems."""
    return reads.select(
        "file", F.expr("trim(LEADING '@' FROM trim(TRAILING '\r' FROM read_id))").alias("read_id"),
        F.expr("trim(TRAILING '\r' FROM seq)").alias("seq"), F.expr("trim(TRAILING '\r' FROM qual)").alias("qual"),
    )


def scan_fastq(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """``file, read_id, seq, qual`` of plain and compressed files, also of both in one folder.

    Compressed files cannot be split, so their lines arrive in order within one task and records are put together
    there. Plain files are split by Spark: from the lines counted in the splits before it, each split knows where its
    first record starts, so records are put together in it as well; only the lines of records that lie in two splits are
    shuffled. A record without ``@`` or ``+``, with sequence and quality of unequal length, or cut short makes the scan
    fail, whatever columns are asked for. Records of four blank lines, as at the end of a file, are left out.
    """
    lines = spark.read.options(**options).text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    start = [F.lit(0).cast("long").alias(name) for name in ("block", "skip")]
    packed = lines.where(PACKED).select("file", *start, "value").mapInArrow(lambda b: _records(b, True), READ_SCHEMA)
    raw, offsets, few = placed_lines(spark, path, f"not ({PACKED})", **options)
    if few:
        skip = F.pmod(-F.col("skipped"), F.lit(4)).alias("skip")
        inside = raw.join(offsets, ["file", "block"]).select("file", "block", skip, "value")
        plain = inside.mapInArrow(lambda b: _records(b, False), READ_SCHEMA).unionByName(_grouped(edge_lines(raw, offsets, 4)))
    else:  # the splits are too many to be sent to all tasks
        plain = _grouped(numbered_lines(spark, path, f"not ({PACKED})", **options))
    return _tidy(packed.unionByName(plain))


def scan_fasta(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """``file, id, description, seq``: wrapped lines joined, upper case. Files are split at record starts."""
    records = (
        spark.read.options(**options, lineSep="\n>").text(path)
        .select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", r"^\s*>", "").alias("record"))
        .filter(F.trim("record") != "")
    )
    body = F.substring_index("record", "\n", 1)
    letters = F.translate(F.expr("substring(record, length(substring_index(record, '\n', 1)) + 1)"), " \t\r\n", "")
    return with_computed(records, head=F.trim(F.translate(body, "\r", "")), seq=F.upper(letters)).select(
        "file", F.element_at(F.split("head", r"\s+"), 1).alias("id"), F.col("head").alias("description"), "seq"
    )


def scan_alleles(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """``scheme, locus, allele, seq`` from files ``<scheme>/<locus>.tfa``; the header is cut at its last underscore.

    Records present twice come back once.
    """
    records = scan_fasta(spark, path, **options)
    return records.select(
        F.element_at(F.split("file", "/"), -2).alias("scheme"),
        F.regexp_extract("id", r"^(.*)_[^_]*$", 1).alias("locus"),
        F.regexp_extract("id", r"_([^_]*)$", 1).alias("allele"),
        "seq",
    ).dropDuplicates()
