"""Audit of how text filters interact, on a sparse document-term matrix.

1. Each shard of documents lists its distinct words. Words get global numbers: they are dealt by hash to buckets, sorted
   there, and a word's number follows from its rank and its bucket. The dictionary is the same for all shards.
2. With these numbers each shard is a block of the document-term matrix in compressed rows (CSR): a row per document, a
   column per word. Row sums are the words of a document, nonzero counts its distinct words; they decide filters A and B.
3. Filters C, D and E are attached (E by the SHA-256 of the texts: of equal texts all but the smallest id fail).
   Documents are then counts by part, failures and labels, and every order of the filters is read off these counts.

Null texts count as empty: A fails, B, C and D don't. Rows that share an id are documents of their own, and of equal
texts with the smallest id none fails E; null ids are neither smaller than another nor larger, so they never fail E.
Labels count where any row of the id holds them. Null lang is the part "". An empty table gives no rows. Extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from itertools import permutations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from isoloom.llm.common import settle
from isoloom.llm.shards import Places, entries, in_shards, listed, one_list, packed, sums_between, unpacked, with_values
from isoloom.session import by_sorting

BUCKET_WORDS = 20_000
FILTERS = "ABCDE"
UPPER = bytes(range(65, 91))
MARKS = b"#$%&*|"


class Terms:
    """Words of the documents of one shard, and the flags that need nothing else."""

    def __init__(self) -> None:
        self.words, self.ids, self.ends = Places(), array("i"), [0]
        self.upper, self.marked, self.digest = [], [], []

    def add(self, text: str | None) -> None:
        blob = (text or "").encode("utf-8", "replace")
        self.ids.extend(map(self.words.__getitem__, blob.split()))  # bytes split at 0x20 and 0x09 to 0x0D alone
        self.ends.append(len(self.ids))
        self.upper.append(100 * (len(blob) - len(blob.translate(None, UPPER))) > 3 * len(text or ""))
        self.marked.append(len(blob.translate(None, MARKS)) < len(blob))
        self.digest.append(hashlib.sha256(blob).digest())

    def lists(self) -> dict:
        """The block in compressed rows; columns are places in the list of words, frequent ones first."""
        import pyarrow as pa

        ids, n = np.frombuffer(self.ids, dtype=np.int32), max(len(self.words), 1)
        order = np.argsort(-np.bincount(ids, minlength=n), kind="stable")
        place = np.empty(n, dtype=np.int64)
        place[order] = np.arange(n)
        words = pa.array(list(self.words), pa.binary()).take(pa.array(order[: len(self.words)])).cast(pa.string())
        cell = np.repeat(np.arange(len(self.ends) - 1) * n, np.diff(self.ends)) + place[ids]
        cell, data = np.unique(cell, return_counts=True)
        row, column = np.divmod(cell, n)
        return {
            "words": words, "starts": np.searchsorted(row, np.arange(len(self.ends))).astype(np.int32),
            "columns": [packed(column)], "data": [packed(data)],
            "upper": self.upper, "marked": self.marked, "digest": self.digest,
        }


LISTS = (
    "words array<string>, starts array<int>, columns array<binary>, data array<binary>, "
    "upper array<boolean>, marked array<boolean>, digest array<binary>"
)


def term_shards(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The blocks with words numbered within each shard, settled."""
    return settle(in_shards(docs, text, keep, LISTS, Terms), "term-shards")


def word_numbers(shards: DataFrame) -> DataFrame:
    """shard, at, word, value: the global number of every word of every shard."""
    total = shards.agg(F.sum(F.size("words"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_WORDS))
    dealt = listed(shards, "words").withColumnRenamed("words", "word")
    dealt = dealt.withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(buckets)))
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy("word"))
    return dealt.select("shard", "at", "word", ((rank - 1) * buckets + F.col("bucket")).cast("long").alias("value"))


def dictionary(shards: DataFrame) -> DataFrame:
    """word, number: one row per distinct word."""
    return word_numbers(shards).select("word", F.col("value").alias("number")).distinct()


def _encoded(row, at: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, ...]:
    """starts, columns (global numbers), data of a shard's block."""
    numbers = np.zeros(int(at.max()) + 1 if len(at) else 0, dtype=np.int64)
    numbers[at] = value
    return entries(row, "starts").astype(np.int64), numbers[unpacked(row, "columns")], unpacked(row, "data")


def matrix(shards: DataFrame, keep: list[str]) -> DataFrame:
    """The document-term matrix: per shard the kept columns as lists, starts, columns (global word numbers, ascending in
    each row) and data."""
    import pyarrow as pa

    kept = [shards.schema[c] for c in keep]
    schema = StructType([shards.schema["shard"], *kept, *StructType.fromDDL("starts array<int>, columns array<long>, data array<int>")])

    def run(row, at, value):
        starts, columns, data = _encoded(row, at, value)
        order = np.lexsort((columns, np.repeat(np.arange(len(starts) - 1), np.diff(starts))))
        lists = [one_list(starts, pa.int32()), one_list(columns[order], pa.int64()), one_list(data[order], pa.int32())]
        return pa.Table.from_arrays([row.column(c) for c in ("shard", *keep)] + lists, names=schema.names)

    return with_values(shards, word_numbers(shards).select("shard", "at", "value"), schema, run)


def document_rows(shards: DataFrame, keep: list[str]) -> DataFrame:
    """A row per document: the kept columns, n_words (row sum), n_distinct (nonzero count), upper, marked, digest."""
    import pyarrow as pa

    rows = StructType()
    for c in (*keep, "upper", "marked", "digest"):
        rows = rows.add(c, shards.schema[c].dataType.elementType)
    rows = rows.add("n_words", "long").add("n_distinct", "long")

    def run(row, at, value):
        starts, _, data = _encoded(row, at, value)
        same = [row.column(c).combine_chunks().flatten() for c in rows.names[:-2]]
        counts = [sums_between(data, starts), np.diff(starts)]
        return pa.Table.from_arrays([*same, *[pa.array(c, pa.int64()) for c in counts]], names=rows.names)

    return with_values(shards, word_numbers(shards).select("shard", "at", "value"), rows, run)


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, fails (a bit per filter), good, toxic, n: how many documents there are of each kind."""
    rows = document_rows(term_shards(docs, ["doc_id", "lang"]), ["doc_id", "lang"])
    fails = F.when(F.col("n_words") < 200, 1).otherwise(0)
    for bit, failed in ((2, 100 * F.col("n_distinct") < 50 * F.col("n_words")), (4, F.col("upper")), (8, F.col("marked"))):
        fails = fails + F.when(failed, bit).otherwise(0)
    rows = rows.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), "digest", fails.alias("fails"))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    rows = rows.join(by_sorting(marks), "doc_id", "left").fillna(False, ["good", "toxic"])
    kind = ("digest", "part", "fails", "good", "toxic")
    held = rows.groupBy("doc_id", *kind).agg(F.count("*").alias("n"))
    # Equal texts are few rows from here on: counts by part and labels, with the smallest id and its count.
    texts = held.groupBy(*kind).agg(
        F.sum("n").alias("n"), F.sum(F.expr("if(doc_id is null, n, 0)")).alias("nameless"),
        F.min(F.expr("if(doc_id is null, null, struct(doc_id, n))")).alias("first"),
    )
    texts = texts.withColumn("lowest", F.min("first.doc_id").over(Window.partitionBy("digest")))
    stay = F.col("nameless") + F.coalesce(F.expr("if(first.doc_id = lowest, first.n, 0)"), F.lit(0))
    texts = texts.select("part", "fails", "good", "toxic", F.inline(F.array(
        F.struct(F.lit(0).alias("repeats"), stay.alias("n")), F.struct(F.lit(16).alias("repeats"), (F.col("n") - stay).alias("n"))
    )))
    return texts.groupBy("part", (F.col("fails") + F.col("repeats")).alias("fails"), "good", "toxic").agg(F.sum("n").alias("n"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step: what the step keeps and removes, what it fails besides, and
    the filter's removals over all orders (its Shapley value times the number of orders)."""
    orders = list(permutations(range(len(FILTERS))))
    steps = F.array(*[
        F.struct(
            F.lit("".join(FILTERS[f] for f in order)).alias("filter_order"), F.lit(k + 1).alias("step"),
            F.lit(1 << order[k]).alias("own"), F.lit(sum(1 << f for f in order[:k])).alias("earlier"),
        )
        for order in orders for k in range(len(FILTERS))
    ])
    counts = settle(failures(docs, labels), "failures")
    rows = counts.select("*", F.inline(steps))

    def number(condition: str, weight: str = "n") -> F.Column:
        return F.sum(F.expr(f"if({condition}, {weight}, 0L)"))

    removed = "fails & own <> 0 and fails & earlier = 0"
    return rows.groupBy("part", "filter_order", "step").agg(
        number("fails & (own | earlier) = 0").alias("kept"), number(removed).alias("removed"),
        number("fails & own <> 0 and fails & earlier <> 0").alias("redundant"), number("fails = own").alias("unique_fails"),
        number(f"{removed} and good").alias("good_lost"), number(f"{removed} and toxic").alias("toxic_lost"),
        number("fails & own <> 0", f"n * ({len(orders)} div bit_count(fails))").alias("shapley"),
    )
