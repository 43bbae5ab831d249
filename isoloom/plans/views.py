"""Isolate tables derived from the generic test tables, whole tables and whole texts each.

They stand in for real sheets, reads, contigs and result files; the operators know nothing about them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isoloom.functions.dna import revcomp
from isoloom.operators.scan import in_pieces
from isoloom.session import spread, with_computed

LETTERS, BASES = "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC"
PIECE = 100
READS = "sample string, pair_id string, mate int, seq string, qual string"
READ_LETTERS = 1_000_000
TO_BASES = bytes.maketrans(LETTERS.encode(), BASES.encode())
NO_BASES = bytes(set(range(256)) - set(LETTERS.encode()))
LOCI = 7
FIRST_SCHEME_LOCI = 4
STORE = "/store"
SPECIES = ("Enterococcus faecium", "Klebsiella pneumoniae", "Acinetobacter baumannii", "Candida auris", "Unknown bug")
SITES = ("ALIC", "CAST", "ELCH", "GRAL", "PESE", "CLIN", "LAFE", "EPIM", "XXXX")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text"))


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _nth(values: tuple[str, ...], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def dna(text: Column) -> Column:
    return F.translate(F.regexp_replace(F.lower(text), "[^a-z]+", ""), LETTERS, BASES)


# --- sheets ---------------------------------------------------------------------------------------------------------


def run_of(customer: Column) -> Column:
    day = F.lpad((customer % 28 + 1).cast("string"), 2, "0")
    serial = F.lpad((customer % 20).cast("string"), 3, "0")
    stamp = F.when(customer % 50 == 7, "2405").otherwise(F.concat(F.lit("2405"), day))
    return F.concat(stamp, F.lit("_"), _nth(SITES, customer % 9), serial)


def sheet_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hospital sheet as written, one row per order, with ``sheet`` (one per run) and ``row_no``."""
    orders = spread(table(spark, sf_dir, "orders"))
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    run = run_of(c)
    day, month, year = (f("o_orderdate").cast("string") for f in (F.dayofmonth, F.month, F.year))
    date = (
        F.when(k % 6 == 0, F.concat_ws("/", day, month, F.substring(year, 3, 2)))
        .when(k % 6 == 1, F.concat_ws(".", F.lpad(day, 2, "0"), F.lpad(month, 2, "0"), year))
        .when(k % 6 == 2, F.concat_ws("-", year, month, day))
        .when(k % 6 == 3, F.concat_ws("/", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")))
        .when(k % 6 == 4, F.concat(F.lit("31/"), F.lpad(month, 2, "0"), F.lit("/"), year))
        .when(k % 12 == 5, " ")
    )
    ident = (
        F.when(k % 997 == 0, F.lit(None)).when(k % 101 == 0, _text("M ", k)).when(k % 103 == 0, _text("ñ", k))
        .otherwise(_text("M", k))
    )
    path = lambda tail: F.concat(F.lit("/d/"), run, F.lit("/M"), k.cast("string"), F.lit(tail))
    return orders.select(
        run.alias("sheet"),
        run.alias("run"),
        (k + 2).alias("row_no"),
        ident.alias("CODIGO_MUESTRA_ORIGEN"),
        F.when(c % 11 == 0, "  ").otherwise(_text("P", c)).alias("PETICION"),
        date.alias("FECHA_TOMA_MUESTRA"),
        F.when(k % 13 != 0, _nth(SPECIES, k % 5)).alias("ESPECIE_SECUENCIA"),
        F.when(k % 17 == 0, "").otherwise("Vigilancia").alias("MOTIVO_WGS"),
        F.when(k % 19 == 0, _text("B", k)).alias("NUM_BROTE"),
        F.col("o_orderstatus").alias("CONFIRMACION"),
        F.col("o_orderpriority").alias("COMENTARIO_WGS"),
        F.when(k % 4 < 2, path("_S1_R1_001.fastq.gz")).alias("ILLUMINA_R1"),
        F.when(k % 4 != 2, path("_S1_R2_001.fastq.gz")).alias("ILLUMINA_R2"),
        F.when((k % 4 == 2) | (k % 8 == 1), path(".fastq.gz")).alias("NANOPORE"),
    )


def sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same under internal names."""
    from isoloom.operators.validation import rename_internal

    return rename_internal(sheet_raw(spark, sf_dir))


def stored_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that exist: those of orders whose key is no multiple of five."""
    s = sheet_raw(spark, sf_dir).filter((F.col("row_no") - 2) % 5 != 0)
    cols = F.array_compact(F.array("ILLUMINA_R1", "ILLUMINA_R2", "NANOPORE"))
    return s.select(F.explode(cols).alias("path"))


def read_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names of many shapes, one or two per order: ``path, ext_rank``."""
    from isoloom.functions.names import extension_rank

    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    shapes = (
        "_S5_R{m}_001.fastq.gz", "_S5_L001_R{m}_001.fastq.gz", "_R{m}.fq", ".r{m}.fastq.gz", "_{f}.fq.gz", "_S2_r{m}_001.fastq",
        ".x_R{m}.fastq", "_{m}.fastq.gz",
    )
    mates = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(f).alias("f")) for m, f in (("1", "F"), ("2", "R"))])
    rows = o.select(k, F.explode(mates).alias("x")).filter((k % 9 != 0) | (F.col("x.m") == "1"))
    shape = F.replace(F.replace(_nth(shapes, k % 8), F.lit("{m}"), F.col("x.m")), F.lit("{f}"), F.col("x.f"))
    ident = F.concat(F.lit("A"), F.expr("o_orderkey div 3").cast("string"))
    path = F.concat(F.lit("/d/f"), (k % 3).cast("string"), F.lit("/"), ident, shape)
    return rows.select(path.alias("path")).withColumn("ext_rank", extension_rank(F.col("path")))


# --- result files ---------------------------------------------------------------------------------------------------


def _hit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    line = ((F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("decimal(22,0)") * F.lit(10**12).cast("decimal(13,0)")
            + F.col("l_partkey").cast("decimal(20,0)")).cast("decimal(38,0)")
    return item.join(part, F.col("l_partkey") == F.col("p_partkey")).withColumn("line_no", line).withColumn(
        "sample", _text("S", F.col("l_suppkey"))
    )


def amr_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("l_returnflag") == "A", "AMR").when(F.col("l_returnflag") == "N", "VIRULENCE").otherwise("STRESS")
    return _hit_rows(spark, sf_dir).select(
        "sample", kind.alias("type"), F.when(F.col("l_linestatus") == "F", "core").otherwise("plus").alias("scope"),
        F.col("p_brand").alias("symbol"), "line_no",
    )


def resistance_gene_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hit_rows(spark, sf_dir).select(
        "sample", F.when(F.col("p_size") != 7, F.col("p_brand")).alias("gene"), "line_no"
    )


def pheno(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hit_rows(spark, sf_dir).select(
        "sample", F.col("p_name").alias("antimicrobial"), F.when(F.col("p_size") != 13, F.col("p_type")).alias("class"),
        F.when(F.col("l_returnflag") == "R", "Resistant").otherwise("No resistance").alias("predicted"), "line_no",
    )


def drug_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("gene"), F.col("p_type").alias("class"), F.element_at(F.split("p_name", " "), 2).alias("antimicrobial")
    ).distinct()


def mlst_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ragged call lines, one per order; samples overlap those of the hits only in part."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    k = F.col("o_orderkey")
    names = ("aroC", "dnaN", "hemD", "hisD", "purE", "sucA", "thrA")
    loci = [F.when(F.lit(i) < 5 + k % 3, _text(f"{n}(", (k * (i + 3)) % 97, ")")) for i, n in enumerate(names)]
    sample = _text("S", F.col("o_custkey") * 2)
    line = F.concat_ws("\t", sample, F.lower("c_mktsegment"), (k % 500).cast("string"), *loci)
    return o.select(F.concat(line, F.when(k % 7 == 0, "\t ").otherwise("")).alias("value"))


def mlst_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isoloom.sources.results import split_mlst_calls

    return split_mlst_calls(mlst_lines(spark, sf_dir))


def gff_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotation lines per supplier file: features, then ``##FASTA`` and sequence from a certain line on."""
    i = table(spark, sf_dir, "lineitem")
    k, n, p = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    feature = _text("c", p, "\tx\tCDS\t", n, "\t", p, "\t.\t+\t0\tID=g", k, ";name=n", p, ";Name=m", n, ";product=ID=z")
    short = _text("c", p, "\tName=q", n, ";note=", k)
    line = F.when(k % 1000 == 999, "##FASTA").when(k % 3 == 0, short).otherwise(feature)
    pos = ((k * 10 + n).cast("decimal(22,0)") * F.lit(10**12).cast("decimal(13,0)") + p.cast("decimal(20,0)")).cast("decimal(38,0)")
    return i.select(_text("F", F.col("l_suppkey")).alias("file"), pos.alias("line_no"), line.alias("value"))


# --- sequences ------------------------------------------------------------------------------------------------------


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_computed(texts(spark, sf_dir), seq=dna(F.col("text"))).filter(F.col("seq") != "")
    return docs.select(F.col("source").alias("sample"), F.col("doc_id").cast("string").alias("contig_id"), "seq")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut into pieces of 100 bases, the rest of each as a shorter piece; mates alternate.

    Qualities fall along the read at a pace set by the document; N stands at a stride set by document and piece. The
    letters are laid out inside the map tasks, a bounded number of documents at a time.
    """
    docs = texts(spark, sf_dir).select("doc_id", "source", F.lower("text").cast("binary").alias("text")).where("text is not null")
    return docs.mapInArrow(_cut_reads, READS)


def _cut_reads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_pieces(batches, "text", READ_LETTERS):
        bodies = [text.translate(TO_BASES, NO_BASES) for text in batch.column("text").to_pylist()]
        sizes = np.array([len(b) for b in bodies], dtype=np.int64)
        pieces = -(-sizes // PIECE)
        if not pieces.sum():
            continue
        doc = np.repeat(np.arange(len(bodies)), pieces)
        i = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        length = np.minimum(PIECE, sizes[doc] - i * PIECE)
        ends = np.cumsum(length)
        known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
        ids = batch.column("doc_id").fill_null(0).to_numpy()
        stride = np.where(known[doc], 7 + np.fmod(ids[doc] + i, 50), PIECE + 1)  # no id: no N stands in the read
        if not stride.all():
            raise ZeroDivisionError("stride of N")
        fall = np.where(known, np.fmod(ids, 6), 40 * 10)[doc]  # no id: the lowest quality
        base = np.frombuffer(b"".join(bodies), dtype=np.uint8)
        at = np.arange(len(base), dtype=np.int32) - np.repeat(ends - length, length).astype(np.int32) + 1
        seq = np.where(at % np.repeat(stride, length).astype(np.int16) == 0, np.uint8(ord("N")), base)
        drop = at * np.repeat(fall, length).astype(np.int32) // 10 + (at * 7 + base) % 9
        qual = (33 + np.maximum(2, 40 - drop)).astype(np.uint8)
        offsets = pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32))
        texts_of = lambda letters: pa.StringArray.from_buffers(len(doc), offsets, pa.py_buffer(letters))
        of_doc = pa.array(doc)
        pair = [batch.column("doc_id").take(of_doc).cast(pa.string()), pa.array(i // 2).cast(pa.string())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("source").take(of_doc), pc.binary_join_element_wise(*pair, "_", null_handling="skip"),
             pa.array((i % 2 + 1).astype(np.int32)), texts_of(seq), texts_of(qual)],
            ["sample", "pair_id", "mate", "seq", "qual"],
        )


def alleles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages as alleles of seven loci, the first four in one scheme, the others in another."""
    b = table(spark, sf_dir, "benchmark")
    locus = F.col("item_id") % LOCI
    out = b.select(
        F.when(locus < FIRST_SCHEME_LOCI, "s1").otherwise("s2").alias("scheme"), _text("loc", locus).alias("locus"),
        F.col("item_id").cast("string").alias("allele"), dna(F.col("text")).alias("seq"),
    )
    return out.filter("seq <> ''")


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alleles(spark, sf_dir).select(F.concat(F.lit("gene"), "allele").alias("gene"), "seq")


def mutate(seq: Column, every: int) -> Column:
    """Every n-th base complemented."""
    steps = F.sequence(F.lit(1), F.length(seq))
    letter = lambda p: seq.substr(p, F.lit(1))
    return F.array_join(F.transform(steps, lambda p: F.when(p % every == 0, F.translate(letter(p), "ACGT", "TGCA")).otherwise(letter(p))), "")


def planted_contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One contig per benchmark passage: copies of it, some changed, some reversed, between flanks.

    Sample ``plant<n>`` holds the seven loci of passages 7n to 7n+6. In one sample of four a locus is changed, in one
    it is cut, in one it is missing and in one a second allele is added.
    """
    b = table(spark, sf_dir, "benchmark").select("item_id", dna(F.col("text")).alias("g")).filter("g <> ''")
    item, g = F.col("item_id"), F.col("g")
    group, locus = F.expr(f"item_id div {LOCI}"), item % LOCI
    changed = (
        F.when((group % 4 == 1) & (locus == 3), mutate(g, 25))
        .when((group % 4 == 2) & (locus == 5), F.expr("substring(g, 1, length(g) * 2 div 5)"))
        .when((group % 4 == 3) & (locus == 2), "")
        .otherwise(g)
    )
    body = F.concat(F.lit("ACCA"), changed, F.lit("TGGT"))
    oriented = F.when(item % 2 == 1, revcomp(body)).otherwise(body)
    own = b.select(_text("plant", group).alias("sample"), _text("p", item).alias("contig_id"), oriented.alias("seq"))
    extra = b.filter((group % 4 == 0) & (item >= LOCI) & (locus == 6)).select(
        _text("plant", group - 1).alias("sample"), _text("x", item).alias("contig_id"), g.alias("seq")
    )
    return own.unionByName(extra)


def screen_contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents plus one changed copy of every passage: every 15th base complemented, every other one reversed."""
    b = table(spark, sf_dir, "benchmark").select("item_id", dna(F.col("text")).alias("g")).filter("g <> ''")
    body = F.concat(F.lit("ACCA"), mutate(F.col("g"), 15), F.lit("TGGT"))
    seq = F.when(F.col("item_id") % 2 == 1, revcomp(body)).otherwise(body)
    copies = b.select(_text("copy", F.col("item_id")).alias("sample"), _text("q", F.col("item_id")).alias("contig_id"), seq.alias("seq"))
    return contigs(spark, sf_dir).unionByName(copies)


def typing_contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contigs(spark, sf_dir).unionByName(planted_contigs(spark, sf_dir))


def wide_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``scheme, ST, loc0..loc6``: one type per whole group of passages, and a decoy that mixes neighbouring groups."""
    b = table(spark, sf_dir, "benchmark").withColumn("grp", F.expr(f"item_id div {LOCI}")).withColumn("locus", F.col("item_id") % LOCI)
    cells = [F.max(F.when(F.col("locus") == i, F.col("item_id"))).cast("string").alias(f"loc{i}") for i in range(LOCI)]
    groups = b.groupBy("grp").agg(F.count("*").alias("n"), *cells).filter(F.col("n") == LOCI)
    names = [f"loc{i}" for i in range(LOCI)]
    real = groups.select((F.col("grp") + 1).alias("ST"), *names)
    shifted = [(F.col(c).cast("long") + LOCI).cast("string").alias(c) if i % 2 == 0 else F.col(c) for i, c in enumerate(names)]
    decoy = groups.select((F.col("grp") + 100001).alias("ST"), *shifted)
    both = real.unionByName(decoy).withColumn("ST", F.col("ST").cast("string"))
    part = lambda s, kept: both.select(F.lit(s).alias("scheme"), "ST", *[
        (F.col(c) if c in kept else F.lit(None).cast("string")).alias(c) for c in names
    ])
    return part("s1", names[:FIRST_SCHEME_LOCI]).unionByName(part("s2", names[FIRST_SCHEME_LOCI:]))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isoloom.sources.results import long_profiles

    return long_profiles(wide_profiles(spark, sf_dir), "ST", ["scheme"])


# --- taxa -----------------------------------------------------------------------------------------------------------

LEVELS = ("l1", "l2")
TAXON_K = 12


def reference_genomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as reference sequences with the lineage language, then source in that language."""
    lang = F.ascii(F.col("lang")).cast("long") * 1000 + F.ascii(F.substring("lang", 2, 1))
    source = F.regexp_extract("source", r"(\d+)", 1).cast("long")
    return with_computed(texts(spark, sf_dir), seq=dna(F.col("text"))).select(
        lang.alias("l1"), (lang * 100000 + source).alias("l2"), "seq"
    )


def taxon_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as reads: two turns make a pair."""
    c = spread(table(spark, sf_dir, "conversations"))
    return with_computed(c, seq=dna(F.col("text"))).select(
        _text("C", F.col("conv_id") % 12).alias("sample"),
        F.concat_ws("_", F.col("conv_id").cast("string"), F.expr("turn div 2").cast("string")).alias("read_id"),
        (F.col("turn") % 2 + 1).alias("mate"), "seq",
    )
