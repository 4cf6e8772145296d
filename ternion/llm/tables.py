"""Reading the corpus tables and keeping Arrow batches small enough for long texts."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch on its way to Python. Texts may be very long, so both are bounded.
ARROW_ROWS, ARROW_BYTES = 1024, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches for the plans built from here on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hand_back() -> None:
    """Give freed memory back to the system: Arrow's and C's allocators keep it otherwise, and a driver lives on beside its JVM."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
        trim(0)


def handing_back(work: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """``work`` over the batches of a task, with freed memory given back after each batch and at the end: workers live on from task to task and stage to stage beside their JVM."""

    def fed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            del batch
            hand_back()

    @wraps(work)
    def run(batches: Iterator[pa.RecordBatch], *rest) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(fed(batches), *rest)
        finally:
            hand_back()

    return run


def shrink_executors(spark: SparkSession) -> None:
    """Have every executor's JVM collect its garbage, upon which it gives back the heap that an earlier stage needed and this one's Python workers need now.

    One short task a core; an executor that no task reaches keeps what it has, which changes no result.
    """
    cores = max(1, spark.sparkContext.defaultParallelism)
    spark.range(0, cores, 1, cores).select(F.expr("reflect('java.lang.System', 'gc')").alias("x")).write.format("noop").mode("overwrite").save()
