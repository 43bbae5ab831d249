"""Base qualities: texts with one character per base."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

OFFSET = 33


def phred(qual: Column) -> Column:
    """Numbers of the quality characters."""
    return F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.ascii(c) - OFFSET)


def count_below(qual: Column, limit: int) -> Column:
    """Bases whose quality is below the limit, counted on the text itself."""
    lower = "".join(chr(OFFSET + q) for q in range(limit))
    return F.length(qual) - F.length(F.translate(qual, lower, ""))


def count_from(qual: Column, limit: int) -> Column:
    return F.length(qual) - count_below(qual, limit)


def total(q: Column) -> Column:
    return F.aggregate(q, F.lit(0), lambda acc, x: acc + x)


def _ends(qual: pd.Series, window: pd.Series, mean: pd.Series) -> pd.Series:
    """End of the last window of good mean in each text, 0 without one; a whole batch in a few array steps."""
    qual, w = qual.fillna(""), int(window.iloc[0])
    need = w * (int(mean.iloc[0]) + OFFSET)
    sizes = qual.str.len().to_numpy(dtype=np.int64)
    codes = np.frombuffer("".join(qual).encode("ascii"), dtype=np.uint8)
    upto = np.concatenate(([0], np.cumsum(codes, dtype=np.int64)))
    begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    read_of = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(codes)) - begins[read_of]
    inside = np.flatnonzero(at + w <= sizes[read_of])
    good = inside[upto[inside + w] - upto[inside] >= need]
    keep = np.zeros(len(sizes), dtype=np.int32)
    np.maximum.at(keep, read_of[good], (at[good] + w).astype(np.int32))
    return pd.Series(keep)


# Marked so that a later filter on trimmed reads does not run the function a second time.
_last_good_end = F.pandas_udf(_ends, IntegerType()).asNondeterministic()


def tail_keep(qual: Column, window: int = 10, mean: int = 20) -> Column:
    """Bases to keep: up to the end of the last window whose mean is high enough, 0 if there is none.

    Array functions can say this too, but were slower when tried, as each base is a step of an interpreted fold; here a
    batch of reads is one running sum.
    """
    return _last_good_end(qual, F.lit(window), F.lit(mean))
