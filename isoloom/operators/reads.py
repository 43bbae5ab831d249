"""Trimming, filtering and counting of reads: columns sample, pair_id, mate, seq, qual."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoloom.functions.dna import count_of
from isoloom.functions.quality import count_below, count_from, tail_keep

# Defaults of the filters.
TAIL_WINDOW, TAIL_MEAN = 10, 20
MIN_LENGTH = 50
LOW_QUALITY, LOW_SHARE, MAX_N = 15, 40, 5
MIN_READS = 1000
VERDICTS = ("passed", "low_quality", "too_many_n", "too_short")


def cut_tail(reads: DataFrame, window: int = TAIL_WINDOW, mean: int = TAIL_MEAN) -> DataFrame:
    """Reads cut behind the last window of good mean quality; reads without one become empty."""
    kept = reads.withColumn("_keep", tail_keep(F.col("qual"), window, mean))
    return kept.withColumns({c: F.col(c).substr(F.lit(1), F.col("_keep")) for c in ("seq", "qual")}).drop("_keep")


def low_quality(qual: Column) -> Column:
    """More than the allowed share of bases below the quality limit."""
    return count_below(qual, LOW_QUALITY) * 100 > F.length(qual) * LOW_SHARE


def too_many_n(seq: Column) -> Column:
    return count_of(seq, "N") > MAX_N


def verdict(seq: Column, qual: Column, min_length: int = MIN_LENGTH) -> Column:
    return (
        F.when(F.length(seq) == 0, "too_short")
        .when(low_quality(qual), "low_quality")
        .when(too_many_n(seq), "too_many_n")
        .when(F.length(seq) < min_length, "too_short")
        .otherwise("passed")
    )


def quality_filter(reads: DataFrame) -> DataFrame:
    """Reads with few enough poor bases and Ns, judged as they come."""
    return reads.filter(~low_quality(F.col("qual")) & ~too_many_n(F.col("seq")))


def _both_mates(reads: DataFrame) -> DataFrame:
    """Reads of which each mate is there, however often."""
    pair = Window.partitionBy("sample", "pair_id")
    there = lambda m: F.max((F.col("mate") == m).cast("int")).over(pair) == 1
    return reads.withColumn("_both", there(1) & there(2)).filter("_both").drop("_both")


def length_filter(reads: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """Long enough reads whose mate is long enough too; the pair is brought together by one shuffle."""
    return _both_mates(reads.filter(F.length("seq") >= min_length))


def filter_reads(reads: DataFrame) -> DataFrame:
    """The whole chain: cut the tail, judge each read, keep pairs of which both passed."""
    judged = cut_tail(reads).filter(verdict(F.col("seq"), F.col("qual")) == "passed")
    return _both_mates(judged)


def filter_summary(reads: DataFrame) -> DataFrame:
    """Per sample reads, bases, Q20 and Q30 shares before and after, and reads per verdict.

    Sequences stay where they were scanned: only their counts travel to the pair and on to the sample.
    """
    measured = lambda: F.struct(
        F.length("seq").cast("long").alias("bases"),
        count_from(F.col("qual"), 20).alias("q20"),
        count_from(F.col("qual"), 30).alias("q30"),
    )
    before = reads.withColumn("_before", measured())
    after = cut_tail(before).withColumns({"_verdict": verdict(F.col("seq"), F.col("qual")), "_after": measured()})
    parts = [(side, what) for side in ("before", "after") for what in ("bases", "q20", "q30")]
    passed = F.col("_verdict") == "passed"
    counted = {"before": F.lit(True), "after": passed}
    pairs = after.groupBy("sample", "pair_id").agg(
        F.count("*").alias("reads"), F.bool_or(passed & (F.col("mate") == 1)).alias("first"), F.bool_or(passed & (F.col("mate") == 2)).alias("second"),
        *[F.sum(F.when(counted[side], F.col(f"_{side}.{what}"))).alias(f"{what}_{side}") for side, what in parts],
        *[F.count_if(F.col("_verdict") == v).alias(v) for v in VERDICTS],
    )
    survives = F.col("first") & F.col("second")
    out = pairs.groupBy("sample").agg(
        F.sum("reads").alias("reads_before"),
        F.sum(F.when(survives, F.col("passed")).otherwise(0)).alias("reads_after"),
        *[F.sum(f"{what}_before").alias(f"{what}_before") for what in ("bases", "q20", "q30")],
        *[F.sum(F.when(survives, F.col(f"{what}_after")).otherwise(0)).alias(f"{what}_after") for what in ("bases", "q20", "q30")],
        *[F.sum(v).alias(v) for v in VERDICTS],
    )
    rate = lambda what, side: F.round(F.try_divide(F.col(f"{what}_{side}"), F.col(f"bases_{side}")), 6).alias(f"{what}_rate_{side}")
    return out.select(
        "sample", "reads_before", "bases_before", rate("q20", "before"), rate("q30", "before"),
        "reads_after", "bases_after", rate("q20", "after"), rate("q30", "after"), *VERDICTS,
    )


def read_count(samples: DataFrame, lines: DataFrame) -> DataFrame:
    """Reads per sample from the lines (``sample, mate``) of its read files; four lines make a read, absent files count 0.

    Lines that are counted already, as per file, have their number in ``n``."""
    n = F.col("n") if "n" in lines.columns else F.lit(1)
    per_sample = lines.groupBy("sample").agg(
        F.sum(n).alias("n"), *[F.sum(F.when(F.col("mate") == m, n)).alias(f"n{m}") for m in (1, 2)]
    )
    fourth = lambda c: F.expr(f"coalesce({c}, 0) div 4")
    return samples.select("sample").distinct().join(per_sample, "sample", "left").select(
        "sample", fourth("n").alias("reads"), fourth("n1").alias("reads_r1"), fourth("n2").alias("reads_r2")
    )


def min_reads_gate(counts: DataFrame, min_reads: int = MIN_READS) -> DataFrame:
    """Samples with more first mates than the limit."""
    return counts.filter(F.col("reads_r1") > min_reads)
