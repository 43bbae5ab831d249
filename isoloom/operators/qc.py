"""Quality profiles of reads, per sample and mate."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from isoloom.functions.dna import count_of
from isoloom.functions.quality import OFFSET, phred, total
from isoloom.operators.reads import cut_tail

FILE_KEY = ("sample", "mate")
LETTERS_AT_ONCE = 2_000_000
QUANTILES = {"p10": 0.1, "q1": 0.25, "median": 0.5, "q3": 0.75, "p90": 0.9}


def staged(reads: DataFrame) -> DataFrame:
    """Raw and trimmed reads on top of each other, told apart by ``stage``; the scan unfolds into both."""
    trimmed = cut_tail(reads.select("*", F.col("qual").alias("_raw")))
    both = F.array(
        F.struct(F.lit("raw").alias("stage"), F.col("_raw").alias("qual")),
        F.struct(F.lit("trimmed").alias("stage"), F.col("qual").alias("qual")),
    )
    return trimmed.select(*FILE_KEY, F.explode(both).alias("s")).select("s.stage", *FILE_KEY, "s.qual")


def position_counts(reads: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys``, pos (from 1), letter (its code) and n: how often each letter of an ASCII text stands at each position.

    Letters are counted inside the map tasks, a bounded piece of a batch at a time, so what leaves a task are counts."""
    shape = StructType([reads.schema[k] for k in keys]).add("pos", "long").add("letter", "integer").add("n", "long")

    def run(batches):
        for batch in batches:
            frame = batch.select(keys).to_pandas()
            file = frame.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
            first = np.unique(file, return_index=True)[1]
            texts = [t.encode() if t else b"" for t in batch.column(text).to_pylist()]
            ends = np.cumsum([len(t) for t in texts])
            begin = 0
            while begin < len(texts):
                done = ends[begin - 1] if begin else 0
                stop = max(begin + 1, int(np.searchsorted(ends, done + LETTERS_AT_ONCE)))
                sizes = np.array([len(t) for t in texts[begin:stop]])
                letters = np.frombuffer(b"".join(texts[begin:stop]), dtype=np.uint8).astype(np.int64)
                starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
                place = np.arange(len(letters)) - starts
                code = (np.repeat(file[begin:stop], sizes) << 40 | place) << 8 | letters
                found, n = np.unique(code, return_counts=True)
                rows = batch.select(keys).take(pa.array(first[found >> 48]))
                columns = [pa.array((found >> 8 & ((1 << 40) - 1)) + 1), pa.array((found & 255).astype(np.int32)), pa.array(n)]
                yield pa.RecordBatch.from_arrays([*rows.columns, *columns], names=shape.names)
                begin = stop

    counted = reads.select(*keys, text).mapInArrow(run, shape)
    return counted.groupBy(*keys, "pos", "letter").agg(F.sum("n").alias("n"))


def per_base_quality(staged_reads: DataFrame) -> DataFrame:
    """Per position mean and exact quantiles.

    Bases are first counted per quality value inside the map tasks, so the shuffle carries positions times quality
    values, and the quantiles are taken from those counts.
    """
    histogram = position_counts(staged_reads, ["stage", *FILE_KEY], "qual").withColumn("q", F.col("letter") - OFFSET)
    return _quality_points(histogram, ["stage", *FILE_KEY, "pos"])


def _quality_points(histogram: DataFrame, key: list[str]) -> DataFrame:
    points = F.percentile("q", F.array(*[F.lit(p) for p in QUANTILES.values()]), F.col("n"))
    out = histogram.groupBy(*key).agg(
        F.sum("n").alias("bases"), (F.sum(F.col("q") * F.col("n")) / F.sum("n")).alias("mean"), points.alias("points")
    )
    return out.select(
        *key, "bases", F.round("mean", 6).alias("mean"),
        *[F.round(F.col("points")[i], 6).alias(name) for i, name in enumerate(QUANTILES)],
    )


def per_read_quality(reads: DataFrame) -> DataFrame:
    scored = reads.filter(F.length("qual") > 0).select(*FILE_KEY, total(phred(F.col("qual"))).alias("t"), F.length("qual").alias("n"))
    return scored.groupBy(*FILE_KEY, F.expr("t div n").alias("mean_quality")).agg(F.count("*").alias("reads"))


def _by_base(counts: DataFrame) -> DataFrame:
    of = lambda b: F.coalesce(F.sum(F.when(F.col("letter") == ord(b), F.col("n"))), F.lit(0)).alias(b)
    return counts.groupBy(*FILE_KEY, "pos").agg(F.sum("n").alias("bases"), *map(of, "ACGTN"))


def base_counts(reads: DataFrame) -> DataFrame:
    return _by_base(position_counts(reads, list(FILE_KEY), "seq"))


def base_content(reads: DataFrame) -> DataFrame:
    """Share of each base per position, in percent."""
    return _base_shares(base_counts(reads))


def _base_shares(counts: DataFrame) -> DataFrame:
    share = lambda b: F.round(F.col(b) * 100.0 / F.col("bases"), 6).alias(f"pct_{b.lower()}")
    return counts.select(*FILE_KEY, "pos", *[share(b) for b in "ACGTN"])


def n_content(reads: DataFrame) -> DataFrame:
    return _n_share(base_counts(reads))


def _n_share(counts: DataFrame) -> DataFrame:
    return counts.select(*FILE_KEY, "pos", F.round(F.col("N") * 100.0 / F.col("bases"), 6).alias("pct_n"))


def gc_distribution(reads: DataFrame) -> DataFrame:
    gc = F.round(count_of(F.col("seq"), "GC") * 100.0 / F.length("seq")).cast("long")
    return reads.filter(F.length("seq") > 0).groupBy(*FILE_KEY, gc.alias("gc_percent")).agg(F.count("*").alias("reads"))


def length_distribution(reads: DataFrame) -> DataFrame:
    return reads.groupBy(*FILE_KEY, F.length("seq").cast("long").alias("length")).agg(F.count("*").alias("reads"))


def sequence_counts(reads: DataFrame) -> DataFrame:
    return reads.groupBy(*FILE_KEY, "seq").agg(F.count("*").alias("copies"))


def duplication_levels(reads: DataFrame) -> DataFrame:
    """How many distinct sequences occur how often, with the reads they stand for."""
    levels = sequence_counts(reads).groupBy(*FILE_KEY, "copies").agg(F.count("*").alias("sequences"))
    return levels.withColumn("reads", F.col("copies") * F.col("sequences"))


def deduplicated_share(levels: DataFrame) -> DataFrame:
    """Percent of reads left when each sequence is kept once."""
    return levels.groupBy(*FILE_KEY).agg(F.round(F.sum("sequences") * 100.0 / F.sum("reads"), 6).alias("pct_left"))


def overrepresented(reads: DataFrame, percent: float = 0.1) -> DataFrame:
    """Sequences that make up more than ``percent`` of the reads of their file, the most frequent first.

    The totals come from the counted sequences, so reads are counted once; how the totals, one row per file, are joined
    is decided at run time by their size.
    At most 100/percent sequences per file pass the test, so the ranking works on small groups.
    """
    counts = sequence_counts(reads)
    totals = counts.groupBy(*FILE_KEY).agg(F.sum("copies").alias("total"))
    frequent = counts.join(totals, list(FILE_KEY)).filter(F.col("copies") * 100.0 > F.col("total") * percent)
    order = Window.partitionBy(*FILE_KEY).orderBy(F.desc("copies"), "seq")
    return frequent.select(
        *FILE_KEY, F.row_number().over(order).cast("long").alias("place"), "seq", "copies",
        F.round(F.col("copies") * 100.0 / F.col("total"), 6).alias("percent"),
    )


PROFILE = ("quality", "base", "length", "gc", "read")


def read_profile(reads: DataFrame) -> DataFrame:
    """``sample, mate, kind, at, value, n``: everything that is counted per read or base, from one scan and one shuffle of
    counts. Kinds: ``quality`` (position, quality), ``base`` (position, letter code), ``length`` (length), ``gc``
    (rounded percent) and ``read`` (mean quality, whole part); ``value`` is 0 where one number says it.

    Counts of a task are added up in bounded pieces of a batch; profiles of parts of the data may be stacked and added up
    again, as ``add_profiles`` does."""
    shape = StructType([reads.schema[k] for k in FILE_KEY]).add("kind", "string").add("at", "long").add("value", "long").add("n", "long")

    def run(batches):
        for batch in batches:
            frame = batch.select(list(FILE_KEY)).to_pandas()
            file = frame.groupby(list(FILE_KEY), sort=False, dropna=False).ngroup().to_numpy()
            first = np.unique(file, return_index=True)[1]
            seqs, quals = ([t.encode() if t else b"" for t in batch.column(c).to_pylist()] for c in ("seq", "qual"))
            ends = np.cumsum([len(s) + len(q) for s, q in zip(seqs, quals)])
            begin = 0
            while begin < len(seqs):
                stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + LETTERS_AT_ONCE)))
                for kind, own, at, value in _counted(file[begin:stop], seqs[begin:stop], quals[begin:stop]):
                    code, n = np.unique(own.astype(np.int64) << 40 | at << 8 | value, return_counts=True)
                    rows = batch.select(list(FILE_KEY)).take(pa.array(first[code >> 40]))
                    columns = [pa.array([kind] * len(n), pa.string()), pa.array(code >> 8 & 0xFFFFFFFF), pa.array(code & 255), pa.array(n)]
                    yield pa.RecordBatch.from_arrays([*rows.columns, *columns], names=shape.names)
                begin = stop

    return add_profiles(reads.select(*FILE_KEY, "seq", "qual").mapInArrow(run, shape))


def _counted(file: np.ndarray, seqs: list[bytes], quals: list[bytes]):
    """(kind, file, at, value) of each thing to be counted in these reads."""
    for kind, texts in (("base", seqs), ("quality", quals)):
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        letters = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        place = np.arange(len(letters)) - np.repeat(starts, sizes) + 1
        some = sizes > 0
        sums = lambda x: np.concatenate([[0], np.cumsum(x)])[starts + sizes] - np.concatenate([[0], np.cumsum(x)])[starts]
        if kind == "base":
            yield "base", np.repeat(file, sizes), place, letters
            yield "length", file, sizes, np.zeros(len(sizes), dtype=np.int64)
            twice = 200 * sums((letters == 71) | (letters == 67))[some] + sizes[some]  # halves are rounded up
            yield "gc", file[some], twice // (2 * sizes[some]), np.zeros(some.sum(), dtype=np.int64)
        else:
            yield "quality", np.repeat(file, sizes), place, letters - OFFSET
            yield "read", file[some], sums(letters - OFFSET)[some] // sizes[some], np.zeros(some.sum(), dtype=np.int64)


def add_profiles(profiles: DataFrame) -> DataFrame:
    return profiles.groupBy(*FILE_KEY, "kind", "at", "value").agg(F.sum("n").alias("n"))


def profile_tables(profile: DataFrame) -> dict[str, DataFrame]:
    """The six tables of read quality from one profile, which should be settled before: it is read for each of them."""
    of = lambda kind: profile.where(F.col("kind") == kind)
    one = lambda kind, name: of(kind).select(*FILE_KEY, F.col("at").alias(name), F.col("n").alias("reads"))
    bases = of("base").select(*FILE_KEY, F.col("at").alias("pos"), F.col("value").alias("letter"), "n")
    quality = of("quality").select(*FILE_KEY, F.col("at").alias("pos"), F.col("value").alias("q"), "n")
    return {
        "per_base_quality": _quality_points(quality, [*FILE_KEY, "pos"]), "base_content": _base_shares(_by_base(bases)), "n_content": _n_share(_by_base(bases)),
        "length_distribution": one("length", "length"), "gc_distribution": one("gc", "gc_percent"), "per_read_quality": one("read", "mean_quality"),
    }


def long_metrics(table: DataFrame, stage: str, columns: list[str]) -> DataFrame:
    """``sample, stage, metric, value`` from one column per metric."""
    wide = table.select("sample", *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(["sample"], columns, "metric", "value").select("sample", F.lit(stage).alias("stage"), "metric", "value")


def qc_overview(metrics: DataFrame, names: list[str]) -> DataFrame:
    """One row per sample, one column per named metric."""
    return metrics.groupBy("sample").pivot("metric", names).agg(F.first("value"))
