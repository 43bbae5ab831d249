"""Statistics of assembled contigs: columns sample, contig_id, seq."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoloom.functions.dna import count_of

# Shortest contig counted, and the lengths whose contigs are counted separately.
MIN_CONTIG = 500
THRESHOLDS = (0, 1000, 5000, 10000, 25000, 50000)


def _at_share(percent: int, value: Column) -> Column:
    """``value`` at the first length where the running sum reaches the share of the total."""
    reached = (F.col("upto") * 100 >= F.col("total") * percent) & (F.col("before") * 100 < F.col("total") * percent)
    return F.max(F.when(reached, value))


def assembly_stats(contigs: DataFrame, min_contig: int = MIN_CONTIG) -> DataFrame:
    """Per sample counts, lengths, N50/L50, N90/L90, GC and N content.

    Contigs are first counted per length, so the running sums go over the distinct lengths of a sample: their number
    is bounded by the longest contig whatever the number of contigs.
    """
    seq = F.col("seq")
    used = F.length(seq) >= min_contig
    lengths = contigs.groupBy("sample", F.length(seq).cast("long").alias("len")).agg(
        F.count("*").alias("n"),
        F.sum(F.when(used, count_of(seq, "GC"))).alias("gc"),
        F.sum(F.when(used, count_of(seq, "ACGT"))).alias("acgt"),
        F.sum(F.when(used, count_of(seq, "N"))).alias("n_bases"),
    )
    by_sample = Window.partitionBy("sample")
    falling = by_sample.orderBy(F.desc("len"))
    counted = F.when(F.col("len") >= min_contig, F.col("n")).otherwise(0)
    run = lengths.select(
        "*", counted.alias("k"), (counted * F.col("len")).alias("size")
    ).select(
        "*",
        F.sum("size").over(by_sample).alias("total"),
        F.sum("size").over(falling).alias("upto"),
        F.sum("k").over(falling).alias("rank_upto"),
    ).withColumns({"before": F.col("upto") - F.col("size"), "rank_before": F.col("rank_upto") - F.col("k")})
    place = lambda p: F.col("rank_before") + F.expr(f"(total * {p} - before * 100 + len * 100 - 1) div (len * 100)")
    out = run.groupBy("sample").agg(
        F.sum("k").alias("contigs"),
        F.max("total").alias("total_length"),
        F.max(F.when(F.col("k") > 0, F.col("len"))).alias("largest"),
        *[f for p in (50, 90) for f in (_at_share(p, F.col("len")).alias(f"n{p}"), _at_share(p, place(p)).alias(f"l{p}"))],
        F.sum("gc").alias("gc"), F.sum("acgt").alias("acgt"), F.sum("n_bases").alias("n_bases"),
        *[F.sum(F.when(F.col("len") >= t, F.col("n")).otherwise(0)).alias(f"contigs_{t}") for t in THRESHOLDS],
    )
    return out.select(
        "sample", "contigs", "total_length", "largest", "n50", "l50", "n90", "l90",
        F.round(F.try_divide(F.col("gc") * 100.0, F.col("acgt")), 6).alias("gc_percent"),
        F.round(F.try_divide(F.col("n_bases") * 100000.0, F.col("total_length")), 6).alias("n_per_100kb"),
        *[f"contigs_{t}" for t in THRESHOLDS],
    )
