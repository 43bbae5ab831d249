"""Helpers shared by the training-data operators: settled tables, text batches for numpy, rolling hashes, components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoloom.session import scratch_path

SLICE_BYTES = 1024 * 1024
ROWS_PER_BATCH = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Long texts: hand few rows at a time to Python, so a batch stays within a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends there, and a lost executor costs
    nothing that was settled before."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(sizes: list[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges whose sizes add up to about ``limit``; one larger item is a range of its own."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


# Rolling hash modulo 2**64: the sum of TABLE[byte] * BASE**position; substrings compare after dividing by BASE**start.
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 2**64)
BYTE_CODES = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(maxsize=2)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (BASE, BASE_INVERSE):
        steps = np.full(length, base, dtype=np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(21, int(length).bit_length())
    up, down = _powers(size)
    return up[:length], down[:length]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """``out[i]``: hash sum of the first ``i`` bytes."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_CODES[data] * up[: len(data)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte span, the same for equal bytes wherever they stand."""
    _, down = powers(len(sums))
    return mixed((sums[end] - sums[start]) * down[start])


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit hashes over all bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def joined(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The blobs one after another, a zero byte between them, and the start of each (one more: the end)."""
    starts = np.zeros(len(blobs) + 1, dtype=np.int64)
    np.cumsum([len(b) + 1 for b in blobs], out=starts[1:])
    return np.frombuffer(b"\0".join(blobs) + b"\0", dtype=np.uint8), starts


def encoded(texts) -> list[bytes]:
    return [b"" if t is None else t.encode("utf-8", "replace") for t in texts]


def connected_components(edges: DataFrame, label: str) -> DataFrame:
    """Components of the undirected links ``a``, ``b`` by alternating large and small stars.

    Returns ``node``, ``component`` (the smallest node reachable) for every node that is not the smallest itself.
    Each round is written to the shared scratch folder; rounds grow with the logarithm of the longest chain."""

    def digest(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())

    now = settle(
        edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), label
    )
    seen = digest(now)
    while True:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select("lo", "hi"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        small = large.join(large.groupBy("hi").agg(F.min("lo").alias("m")), "hi")
        pairs = small.select("hi", F.col("m").alias("lo")).union(small.where("lo <> m").select("lo", "m"))
        now = settle(pairs.distinct(), label)
        before, seen = seen, digest(now)
        if before == seen:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("component"))


def with_scores(df: DataFrame, text: str, keep: list[str], fields: str, score) -> DataFrame:
    """Add the columns ``fields`` (DDL) that ``score(list of texts as bytes) -> list of arrays`` gives, and keep the
    columns ``keep``. A kept column that clashes with a new one, in any case, gives way to it."""
    import pyarrow as pa
    from pyspark.sql.types import StructType

    added = StructType.fromDDL(fields)
    taken = {f.name.lower() for f in added}
    keep = [c for c in keep if c.lower() not in taken]
    base = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    schema = StructType([base.schema[c] for c in keep] + list(added))

    def run(batches):
        for batch in batches:
            blobs = encoded(batch.column("__text").to_pylist())
            parts = [score(blobs[a:b]) for a, b in slices([len(b) for b in blobs])]
            columns = [batch.column(c) for c in keep]
            for i in range(len(added)):
                whole = np.concatenate([p[i] for p in parts]) if parts else np.zeros(0)
                columns.append(pa.array(whole))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    return base.mapInArrow(run, schema)


def words_in(data: np.ndarray, starts: np.ndarray, stem: int = 0) -> tuple[np.ndarray, ...]:
    """Start, document and lower-case hash of every run of letters and digits; with ``stem`` also a hash of the first
    ``stem`` bytes (another one than that of a whole word)."""
    begin, end = runs(LETTER[data])
    sums = prefix_hashes(LOWER[data])
    found = begin, np.searchsorted(starts, begin, side="right") - 1, span_hashes(sums, begin, end)
    return (*found, mixed(~span_hashes(sums, begin, np.minimum(end, begin + stem)))) if stem else found


def bounded_sample(labels: DataFrame, docs: DataFrame, values: dict, bound: int) -> DataFrame:
    """At most ``bound`` labelled rows for training, chosen by the hash of their id: doc_id, text and the label columns
    ``values`` (name to expression). Rows held out (``crc32(doc_id) mod 3 = 1``) are never among them."""
    label = labels.where("doc_id is not null and crc32(cast(doc_id as string)) % 3 <> 1").select(
        "doc_id", *[F.expr(e).alias(n) for n, e in values.items()]
    ).dropna()
    label = label.withColumn("__order", F.xxhash64("doc_id")).orderBy("__order", "doc_id", *values).limit(bound)
    label = F.broadcast(label.dropDuplicates(["doc_id"]).drop("__order"))  # at most ``bound`` small rows
    return docs.select("doc_id", "text").join(label, "doc_id").limit(2 * bound)
