"""Sequence expressions. Offsets are taken on binary values, where a slice costs its own length only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 4096


def revcomp(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGT", "TGCA"))


def piece(binary: Column, start: Column | int, size: Column | int) -> Column:
    start = start if isinstance(start, Column) else F.lit(start)
    size = size if isinstance(size, Column) else F.lit(size)
    return F.substring(binary, start, size)


def count_of(seq: Column, letters: str) -> Column:
    return F.length(seq) - F.length(F.translate(seq, letters, ""))


def windows(df: DataFrame, seq: str, k: int, keep: Sequence[str], overhang: int = 0, size: int = WINDOW) -> DataFrame:
    """Sequences cut into windows: the kept columns, ``_offset``, ``_starts`` and ``_bin``.

    Each position at which k letters begin lies in exactly one window, as one of its first ``_starts`` places; the
    window holds those letters and ``overhang`` more where the sequence goes on. Whatever follows works on windows of
    bounded size, so the cost per position does not depend on the length of the sequence.
    """
    whole = df.filter(F.length(seq) >= k).select(*keep, F.col(seq).cast("binary").alias("_whole"))
    places = F.length("_whole") - (k - 1)
    cut = whole.select(*keep, "_whole", F.explode(F.sequence(F.lit(0), places - 1, F.lit(size))).alias("_offset"))
    return cut.select(
        *keep,
        "_offset",
        F.least(F.lit(size), places - F.col("_offset")).alias("_starts"),
        piece(F.col("_whole"), F.col("_offset") + 1, size + k - 1 + overhang).alias("_bin"),
    )


def kmer_rows(df: DataFrame, seq: str, k: int, keep: Sequence[str]) -> DataFrame:
    """One row per position: the kept columns, ``pos`` (from 1) and the k letters there as binary."""
    each = windows(df, seq, k, keep).select(
        *keep, "_offset", "_bin", F.explode(F.sequence(F.lit(1), F.col("_starts"))).alias("_at")
    )
    return each.select(*keep, (F.col("_offset") + F.col("_at")).alias("pos"), piece(F.col("_bin"), F.col("_at"), k).alias("kmer"))


def canonical_kmers(df: DataFrame, seq: str, k: int, keep: Sequence[str]) -> DataFrame:
    """k letters per position, the lesser of both strands; pieces with letters other than ACGT are left out."""
    cut = windows(df, seq, k, keep)
    text = F.col("_bin").cast("string")
    both = cut.select(*keep, "_starts", "_bin", revcomp(text).cast("binary").alias("_rc"), (~text.rlike("[^ACGT]")).alias("_clean"))
    each = both.select(*keep, "_bin", "_rc", "_clean", F.explode(F.sequence(F.lit(1), F.col("_starts"))).alias("_at"))
    here = piece(F.col("_bin"), F.col("_at"), k)
    other = piece(F.col("_rc"), F.length("_rc") - F.col("_at") - (k - 2), k)
    each = each.filter(F.col("_clean") | ~here.cast("string").rlike("[^ACGT]"))
    return each.select(*keep, F.least(here, other).alias("kmer"))
