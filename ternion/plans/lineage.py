"""Cutting lineage through files that every executor can read.

Iterative plans and plans whose row order or task layout must stay fixed are written to the shared
folder named by ``spark.checkpoint.dir`` and read again. A lost executor then costs a re-read, never a
recomputation with another outcome, and nothing lives on one machine's disk only.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_KEY = "spark.checkpoint.dir"
_WRITTEN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only where none is set (local tests) is a temporary one made."""
    found = spark.conf.get(_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_KEY} to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="ternion-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """``df`` written to the shared folder as Parquet and read again: same rows, no lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, *order: Column | str, start: int = 1, name: str = "rank") -> DataFrame:
    """``df`` with the place of each row in an order as a long, counted from ``start``, without one task that sorts all rows.

    Rows are dealt to ranges of the order and sorted there; only a count a range is added up in one place. Nulls come first.
    """
    spark = df.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    at, part = "_at", F.shiftright("_at", 33).alias("_part")
    dealt = cut(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id()), "rank")
    runs = dealt.groupBy(part).agg(F.min(at).alias("_first"), F.count(F.lit(1)).alias("_n"))
    base = runs.select("_part", "_first", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_base"))  # a row a range
    placed = dealt.withColumn("_part", F.shiftright(at, 33)).join(F.broadcast(base), "_part")
    return placed.withColumn(name, F.col(at) - F.col("_first") + F.col("_base") + F.lit(start)).drop("_at", "_part", "_first", "_base")


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch path on whatever file system holds it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def drop_written(spark: SparkSession) -> int:
    """Delete all that cuts of this process have written, once no DataFrame made so far is needed; returns how many paths went."""
    n = len(_WRITTEN)
    while _WRITTEN:
        drop_scratch(spark, _WRITTEN.pop())
    return n
