"""Derived tables laid down as files of the shapes that the sources read, in the session's scratch folder."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoloom.plans import views
from isoloom.session import input_bytes, scratch_path, shuffles_removed

ROWS_PER_CHUNK = 50_000
DOCS_PER_CHUNK = 1_000
PREAMBLE = 17
GZIP_LEVEL = 4
ROUNDS = 4  # in which files are written, from tables of more than so many bytes
ROUND_BYTES = 32 << 20
KNOWN_FOLDERS = 100_000


class _Packed:
    """A gzip file, ended before the stream below it is closed. Arrow's own writer packs at the highest level, which for reads
    takes ten times as long for files a 25th smaller."""

    def __init__(self, out):
        self.out, self.packer = out, zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)

    def write(self, data: bytes) -> None:
        self.out.write(self.packer.compress(data))

    def close(self) -> None:
        self.out.write(self.packer.flush())
        self.out.close()


def _writer(folder: str, head: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        storage, root = fs.FileSystem.from_uri(folder)
        name, out, made = None, None, set()
        for batch in batches:
            names = batch.column("name").dictionary_encode()
            codes = names.indices.fill_null(-1).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
            lines = batch.column("value").to_pylist()
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end or codes[begin] < 0:  # without a name, no file
                    continue
                file = names.dictionary[int(codes[begin])].as_py()
                if file != name:
                    if out:
                        out.close()
                    path = f"{root}/{file}"
                    parent = path.rsplit("/", 1)[0]
                    if parent not in made:
                        storage.create_dir(parent, recursive=True)
                        made = {parent} if len(made) >= KNOWN_FOLDERS else made | {parent}
                    name, out = file, storage.open_output_stream(path, compression=None)
                    out = _Packed(out) if file.endswith(".gz") else out
                    out.write(head.encode())
                out.write(("\n".join(lines[begin:end]) + "\n").encode())
            yield pa.RecordBatch.from_arrays([names.dictionary], ["name"])
        if out:
            out.close()

    return write


def write_named_files(lines: DataFrame, folder: str, order: list[str], head: str = "") -> str:
    """Lines (``name, value`` and order columns) streamed into the file each names, after ``head``; one task writes a file.

    A large table is written in rounds, each with its share of the files, and the shuffle of a round is removed when it is
    done: on the disks lies one round's shuffle beside the files. A folder without scheme is in Spark's default file system,
    not on the disk of the task."""
    spark = lines.sparkSession
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    folder = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(jvm_path).toString()
    rounds = ROUNDS if input_bytes(lines) > ROUND_BYTES else 1
    with shuffles_removed(spark):
        for r in range(rounds):
            part = lines.where(F.pmod(F.xxhash64("name"), F.lit(rounds)) == r) if rounds > 1 else lines
            placed = part.repartition("name").sortWithinPartitions("name", *order).select("name", "value")
            placed.mapInArrow(_writer(folder, head), "name string").write.format("noop").mode("overwrite").save()
    return folder


def sheet_files(spark: SparkSession, sf_dir: str) -> str:
    raw = views.sheet_raw(spark, sf_dir)
    columns = [c for c in raw.columns if c not in ("sheet", "run", "row_no")]
    chunk = F.expr(f"(row_no - 2) div {ROWS_PER_CHUNK}").cast("string")
    quoted = [F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for c in reversed(columns)]
    name = F.concat("sheet", F.lit("."), chunk, F.lit(".csv")).alias("name")
    kinds = [  # two kinds of sheets in one folder: other separator, other order of columns, quoted cells
        (0, F.concat_ws(";", *[F.coalesce(c, F.lit("")) for c in columns]), ";".join(columns)),
        (1, F.concat_ws(",", *quoted), ",".join(reversed(columns))),
    ]
    folder = scratch_path(spark, "sheets")
    for kind, cells, header in kinds:
        lines = raw.where(F.crc32("sheet") % 2 == kind).select(name, cells.alias("value"), "row_no")
        write_named_files(lines, folder, ["row_no"], header + "\n")
    return folder


def mixed_sheet_files(spark: SparkSession, sf_dir: str) -> str:
    """Sheets of four kinds in one folder, by the last digit of their run: complete with a blank line before the header;
    comma, quotes and reversed columns; without the id column; without date and reason. Paths are relative to ``/d``."""
    raw = views.sheet_raw(spark, sf_dir)
    columns = [c for c in raw.columns if c not in ("sheet", "run", "row_no")]
    cells = {c: F.coalesce(F.regexp_replace(c, "^/d/", "") if c in ("ILLUMINA_R1", "ILLUMINA_R2", "NANOPORE") else F.col(c), F.lit("")) for c in columns}
    quoted = {c: F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"')) for c, v in cells.items()}
    name = F.concat("sheet", F.lit("."), F.expr(f"(row_no - 2) div {ROWS_PER_CHUNK}").cast("string"), F.lit(".csv")).alias("name")
    kinds = [
        (";", cells, columns, "\n"), (",", quoted, columns[::-1], ""), (";", cells, [c for c in columns if c != "CODIGO_MUESTRA_ORIGEN"], ""),
        (";", cells, [c for c in columns if c not in ("FECHA_TOMA_MUESTRA", "MOTIVO_WGS")], ""),
    ]
    folder = scratch_path(spark, "mixed-sheets")
    for kind, (separator, values, names, before) in enumerate(kinds):
        rows = raw.where(F.expr(f"cast(right(run, 1) as int) % 4 = {kind}"))
        lines = rows.select(name, F.concat_ws(separator, *[values[c] for c in names]).alias("value"), "row_no")
        write_named_files(lines, folder, ["row_no"], before + separator.join(names) + "\n")
    return folder


def allele_files(spark: SparkSession, sf_dir: str) -> str:
    """The allele library, ``<scheme>/<locus>.tfa``: wrapped lines in lower case, every record twice."""
    alleles = views.alleles(spark, sf_dir)
    record = F.concat(F.lit(">"), "locus", F.lit("_"), "allele", F.lit("\n"), F.lower(F.regexp_replace("seq", "(.{60})(?=.)", "$1\n")))
    lines = alleles.select(F.concat("scheme", F.lit("/"), "locus", F.lit(".tfa")).alias("name"), record.alias("value"), F.explode(F.sequence(F.lit(0), F.lit(1))).alias("copy"), "allele")
    return write_named_files(lines, scratch_path(spark, "library"), ["copy", "allele"])


def amr_files(spark: SparkSession, sf_dir: str) -> str:
    hits = views.amr_hits(spark, sf_dir)
    name = F.concat("sample", F.lit("_amrfinder."), _hit_chunk(), F.lit(".tsv")).alias("name")
    folder = scratch_path(spark, "amr")
    headings = {"symbol": "Element symbol", "scope": "Scope", "type": "Type"}
    for kind, columns in enumerate((("symbol", "scope", "type"), ("type", "symbol", "scope"))):  # two orders of columns
        cells = F.concat_ws("\t", F.lit("p"), *[F.coalesce(c, F.lit("")) for c in columns])
        lines = hits.where(F.crc32("sample") % 2 == kind).select(name, cells.alias("value"), "line_no")
        header = "\t".join(["Protein id", *(headings[c] for c in columns)])
        write_named_files(lines, folder, ["line_no"], header + "\n")
    return folder


def _hit_chunk():
    """Number of a file; of equal width, so that names sort as the rows in them do."""
    return F.lpad(F.floor(F.col("line_no") / F.lit(10**13 * ROWS_PER_CHUNK).cast("decimal(19,0)")).cast("string"), 9, "0")


def gene_files(spark: SparkSession, sf_dir: str) -> str:
    rows = views.resistance_gene_rows(spark, sf_dir)
    lines = rows.select(
        F.concat(_hit_chunk(), F.lit("/"), "sample", F.lit("/ResFinder_results_tab.txt")).alias("name"),
        F.concat_ws("\t", F.coalesce("gene", F.lit("")), F.lit("100")).alias("value"), "line_no",
    )
    return write_named_files(lines, scratch_path(spark, "genes"), ["line_no"], "Resistance gene\tIdentity\n")


def pheno_files(spark: SparkSession, sf_dir: str) -> str:
    rows = views.pheno(spark, sf_dir)
    lines = rows.select(
        F.concat(_hit_chunk(), F.lit("/"), "sample", F.lit("/pheno_table.txt")).alias("name"),
        F.concat_ws("\t", "antimicrobial", F.coalesce("class", F.lit("")), "predicted", F.lit("0"), F.lit("")).alias("value"), "line_no",
    )
    return write_named_files(lines, scratch_path(spark, "pheno"), ["line_no"], "# preamble\n" * PREAMBLE)


def mlst_files(spark: SparkSession, sf_dir: str) -> str:
    lines = views.mlst_lines(spark, sf_dir)
    batch = F.element_at(F.split("value", "\t"), 1)
    return write_named_files(lines.select(F.concat(batch, F.lit("_mlst.tsv")).alias("name"), "value"), scratch_path(spark, "mlst"), ["value"])


def gff_files(spark: SparkSession, sf_dir: str) -> str:
    lines = views.gff_lines(spark, sf_dir)
    named = lines.select(F.concat("file", F.lit("."), _hit_chunk(), F.lit(".gff")).alias("name"), "value", "line_no")
    return write_named_files(named, scratch_path(spark, "gff"), ["line_no"])


def count_files(spark: SparkSession, sf_dir: str) -> str:
    counts = views.reads(spark, sf_dir).groupBy("sample").agg(F.count("*").alias("n"))
    lines = counts.select(F.concat("sample", F.lit("_counts.txt")).alias("name"), F.col("n").cast("string").alias("value"))
    return write_named_files(lines, scratch_path(spark, "counts"), ["value"])


def profile_file(spark: SparkSession, sf_dir: str, scheme: str, loci: list[str]) -> str:
    wide = views.wide_profiles(spark, sf_dir).filter(F.col("scheme") == scheme)
    lines = wide.select(
        F.lit(f"{scheme}.txt").alias("name"), F.concat_ws("\t", "ST", *[F.coalesce(c, F.lit("")) for c in loci], F.lit("")).alias("value"),
        F.col("ST").cast("long").alias("at"),
    )
    header = "\t".join(["ST", *loci, "clonal_complex"])
    return write_named_files(lines, scratch_path(spark, "profiles"), ["at"], header + "\n")


def fastq_files(spark: SparkSession, sf_dir: str, packed: str = "mate = 1") -> str:
    """Reads as files; those for which the condition ``packed`` holds are compressed."""
    reads = views.reads(spark, sf_dir)
    chunk = F.expr(f"cast(split(pair_id, '_')[0] as long) div {DOCS_PER_CHUNK}").cast("string")
    name = F.concat("sample", F.lit("."), chunk, F.lit("_r"), F.col("mate").cast("string"), F.expr(f"if({packed}, '.fastq.gz', '.fastq')"))
    record = F.concat_ws("\n", F.concat(F.lit("@"), "pair_id", F.lit("/"), F.col("mate").cast("string")), "seq", F.lit("+"), "qual")
    return write_named_files(reads.select(name.alias("name"), record.alias("value"), "pair_id"), scratch_path(spark, "fastq"), ["pair_id"])


def fasta_files(spark: SparkSession, sf_dir: str) -> str:
    contigs = views.contigs(spark, sf_dir)
    chunk = F.expr(f"cast(contig_id as long) div {DOCS_PER_CHUNK}").cast("string")
    wrapped = F.regexp_replace("seq", "(.{60})(?=.)", "$1\n")
    record = F.concat(F.lit(">"), "contig_id", F.lit(" from "), "sample", F.lit("\n"), wrapped)
    return write_named_files(
        contigs.select(F.concat("sample", F.lit("."), chunk, F.lit(".fasta")).alias("name"), record.alias("value"), "contig_id"),
        scratch_path(spark, "fasta"), ["contig_id"],
    )


READ_ENDINGS = (".fastq.gz", ".fastq", ".fq.gz", ".fq", ".txt", ".fastq.bak", ".sam.gz")


def text_files(spark: SparkSession, sf_dir: str) -> str:
    """Whole texts of the documents, by source, in files of several endings."""
    docs = views.table(spark, sf_dir, "documents")
    number = F.regexp_extract("source", r"(\d+)", 1).cast("int")
    ending = F.get(F.array(*[F.lit(e) for e in READ_ENDINGS]), number % len(READ_ENDINGS))
    name = F.concat("source", F.lit("_"), F.expr(f"doc_id div {DOCS_PER_CHUNK}").cast("string"), ending)
    return write_named_files(docs.select(name.alias("name"), F.col("text").alias("value"), "doc_id"), scratch_path(spark, "texts"), ["doc_id"])


def manifest_files(spark: SparkSession, sf_dir: str) -> str:
    docs = views.table(spark, sf_dir, "documents")
    name = F.concat("lang", F.lit("/"), "source", F.lit("_"), F.expr(f"doc_id div {DOCS_PER_CHUNK}").cast("string"), F.lit(".txt"))
    return write_named_files(docs.select(name.alias("name"), F.col("text").alias("value"), "doc_id"), scratch_path(spark, "deposit"), ["doc_id"])
