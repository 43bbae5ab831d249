"""Shards: one row holds many documents, and their entries are numbers in a list of distinct keys that the shard has.

A key is then met once per shard instead of once per use, so what all documents must agree on (a number for each word, a
count for each pair) is settled by one shuffle of the lists, and comes back to its shard as (shard, at, value).
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

SHARD_BYTES = 16 * 1024 * 1024  # of texts; one longer text is a shard of its own
ROWS_AT_ONCE = 256


class Places(dict):
    """Number of each key in the order of its first use."""

    def __missing__(self, key) -> int:
        self[key] = place = len(self)
        return place


def one_list(values, kind):
    """A list column of one row."""
    import pyarrow as pa

    values = values if isinstance(values, pa.Array) else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def in_parts(batches):
    """The batches in parts of few rows, as texts may be long."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def in_shards(docs: DataFrame, text: str, keep: list[str], fields: str, make: Callable, limit: int = SHARD_BYTES) -> DataFrame:
    """``shard``, the columns ``keep`` as lists and the lists ``fields`` (DDL), which ``make()`` gathers: an object with
    ``add(text)`` for each document and ``lists()`` at the end of a shard, named like ``fields``."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    base = docs.select(*[F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").alias("__text"))
    kept = [StructField(c, ArrayType(base.schema[f"__{i}"].dataType)) for i, c in enumerate(keep)]
    schema = StructType([StructField("shard", LongType()), *kept, *StructType.fromDDL(fields)])
    kinds = {f.name: f.type.value_type for f in to_arrow_schema(schema) if f.name != "shard"}

    def run(batches):
        first, number = TaskContext.get().partitionId() << 32, 0
        held, size, rows = make(), 0, [[] for _ in keep]

        def row():
            lists = {**dict(zip(keep, rows)), **held.lists()}
            columns = [pa.array([first + number], pa.int64()), *[one_list(lists[c], kinds[c]) for c in kinds]]
            return pa.RecordBatch.from_arrays(columns, names=["shard", *kinds])

        for part in in_parts(batches):
            columns = [part.column(i).to_pylist() for i in range(len(keep) + 1)]
            for *values, text in zip(*columns):
                if size and size + len(text or "") > limit:
                    yield row()
                    number += 1
                    held, size, rows = make(), 0, [[] for _ in keep]
                held.add(text)
                size += len(text or "") + 1
                for column, value in zip(rows, values):
                    column.append(value)
        if size:
            yield row()

    return base.mapInArrow(run, schema)


def listed(shards: DataFrame, column: str, *more: str) -> DataFrame:
    """shard, at, ``column`` (and ``more`` lists beside it) of every key of every shard; lists are cut at the shortest."""
    zipped = F.arrays_zip(*[F.col(c) for c in (column, *more)])
    rows = shards.select("shard", F.posexplode(zipped).alias("at", "entry"))
    return rows.select("shard", "at", *[F.col("entry")[c].alias(c) for c in (column, *more)])


def with_values(shards: DataFrame, values: DataFrame, schema: StructType | str, run: Callable) -> DataFrame:
    """``run(shard row, at, value)`` of each shard with the ``values`` (shard, at, value) that came back to it."""

    def both(left, right):
        return run(left, right.column("at").to_numpy(), right.column("value").to_numpy())

    return shards.groupBy("shard").cogroup(values.groupBy("shard")).applyInArrow(both, schema)


def entries(row, column: str) -> np.ndarray:
    """The list in ``column`` of the one row that a shard is."""
    return row.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False)


def packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers, most of them small, byte plane by byte plane, compressed."""
    return zlib.compress(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(row, column: str) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(row.column(column)[0].values[0].as_py()), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").ravel()


def sums_between(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sum of the values from each cut to the next one."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[cuts[1:]] - total[cuts[:-1]]
