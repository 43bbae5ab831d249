"""Corpus pipeline: quality filter, line dedup, near-duplicate removal, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoloom.llm import line_dedup, mixing, ngram_join, quality, queries
from isoloom.llm.common import settle, small_batches, table
from isoloom.session import by_sorting

ORACLE_SQL = None  # classifier, tokenizer and packing plan have no SQL form; see tests/llm

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of a good grade is high enough stay.

    Each row is judged by its text alone: equal texts share their fate, whatever their ids; null and empty texts have no
    features and the probability of a score of zero, so the trained thresholds decide on all of them alike. An empty table
    stays empty. Further columns of the input are left out."""
    small_batches(spark)
    model = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), queries.GRADE, top=2)
    rated = quality.rate(docs, model, list(DOCUMENT))
    return quality.select(rated, queries.KEEP_GRADE, queries.KEEP_TAIL).select(*DOCUMENT)


def line_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines said before go; a document goes when nothing but blanks is left of a text that had lines removed."""
    left = line_dedup.dedup(docs.select(*DOCUMENT))
    left = left.where("text is null or n_removed = 0 or trim(text) <> ''")
    return left.withColumn("n_chars", F.char_length("text").cast("long")).select(*DOCUMENT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8) the document with the smallest id stays.

    Every row is a document of its own, named by the hash of its columns: rows that share an id but hold different texts
    are told apart, and of several with the smallest id the one with the smallest hash stays. Rows with null ids link
    too and give way to rows with ids. Equal rows count once."""
    small_batches(spark)
    key = F.xxhash64(*DOCUMENT, *[F.col(c).isNull() for c in DOCUMENT])  # the flags, as hashes pass over nulls
    rows = docs.select(*DOCUMENT, key.alias("__key"))
    linked = ngram_join.link(rows.select(F.col("__key").alias("doc_id"), "text"), words=5, percent=80)
    linked = linked.select(F.col("doc_id").alias("__key"), "component_id").distinct()
    places = rows.select("__key", F.struct(F.col("doc_id").isNull(), "doc_id", "__key").alias("place")).distinct()
    first = linked.join(by_sorting(places), "__key").groupBy("component_id").agg(F.min("place").alias("place"))
    stays = first.select(F.col("place")["__key"].alias("__key"))
    return rows.join(by_sorting(stays), "__key", "leftsemi").dropDuplicates(["__key"]).select(*DOCUMENT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, one row per use; the last document of a leaf's epoch may be cut.

    Null lang or source is a leaf of its own. Texts without words, null ones too, take no tokens: they come with each
    whole epoch of their leaf and in a part epoch as far as their place is reached. Rows that share an id are documents
    of their own. An empty table stays empty."""
    used = mixing.cut_texts(mixing.mixed(docs, queries.tree(), queries.MIX))
    return used.withColumn("n_chars", F.char_length("text").cast("long")).select(*DOCUMENT)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the sequences.

    A null or empty text is one piece, the end id. Repeated rows, as the mix brings them, are packed each. An empty table
    gives no pieces."""
    return queries.packed(spark, docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_filter),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
