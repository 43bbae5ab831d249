"""Session helpers: scratch space on shared storage and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_MAX_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD_BYTES = 48


def build_session(
    app: str = "isoloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    return builder.getOrCreate()


@lru_cache(maxsize=None)
def _local_scratch(app_id: str) -> str:
    return tempfile.mkdtemp(prefix="isoloom-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _local_scratch(spark.sparkContext.applicationId)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def bytes_within(df: DataFrame, variable_width: Sequence[str] = (), max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when the rows of ``df`` surely take at most ``max_bytes`` (one aggregate, one row comes back)."""
    width = F.lit(ROW_OVERHEAD_BYTES + 16 * len(df.columns)).cast("long")
    for name in variable_width:
        width = width + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    size = df.agg(F.sum(width).alias("bytes")).first()["bytes"]
    return (size or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, variable_width: Sequence[str] = (), max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint a broadcast only after measuring the side; a larger side is joined by sorting, which spills to disk."""
    return F.broadcast(df) if bytes_within(df, variable_width, max_bytes) else by_sorting(df)


def by_sorting(df: DataFrame) -> DataFrame:
    """Hint a sort-merge join. For sides that grow with the data, above all behind an unfolding of rows, whose size the
    planner guesses from the small file below and would broadcast; skewed keys are still split at run time."""
    return df.hint("merge")


def few_listing_tasks(spark: SparkSession) -> None:
    """List many folders with a few tasks a core. Spark starts a task per folder, for each listing, which takes far longer
    than the folders of samples with one file each."""
    tasks = 4 * spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(tasks))


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is run inside removes the files of its shuffles when it ends; else they lie on the disks until the driver's JVM
    happens to drop them."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files below ``df``, from their listing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def kept(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back. For costly rows that several branches of a plan ask for, as
    each branch would make them anew."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Give a scan with fewer splits than cores (one small file, one unsplittable archive) enough partitions for costly
    per-row work. Scans that already have them, as on large data, are left alone and are not shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < 2 * cores else df


def with_computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns behind a one-row generator, so that later filters and projections reuse their values
    instead of repeating the expressions."""
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(row)))
