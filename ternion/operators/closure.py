"""Transitive closure by doubling rounds over deltas that are only ever appended to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ternion.plans.lineage import cut, drop_scratch, scratch_path


def transitive_closure(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 64) -> DataFrame:
    """Distinct ``(src, dst)`` pairs joined by one or more edges; cycles end the search by themselves. Null ends are ignored.

    A round joins what the last one found with all that is known, so the paths that are covered double in length and
    the rounds grow with the logarithm of the longest. Each round writes its new pairs beside the earlier ones.
    """
    spark = edges.sparkSession
    place = scratch_path(spark, "closure")
    kind = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).schema
    rounds = lambda n: spark.read.schema(kind).parquet(*[f"{place}/{k}" for k in range(n)])
    edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).where("src IS NOT NULL AND dst IS NOT NULL").distinct().write.parquet(f"{place}/0")
    for n in range(1, max_rounds + 1):
        known, delta = rounds(n), spark.read.schema(kind).parquet(f"{place}/{n - 1}")
        ahead = delta.join(known.select(F.col("src").alias("dst"), F.col("dst").alias("to")), "dst").select("src", F.col("to").alias("dst"))
        behind = known.select(F.col("src").alias("from"), F.col("dst").alias("src")).join(delta, "src").select(F.col("from").alias("src"), "dst")
        ahead.union(behind).distinct().join(known, ["src", "dst"], "left_anti").write.parquet(f"{place}/{n}")
        if spark.read.schema(kind).parquet(f"{place}/{n}").isEmpty():
            drop_scratch(spark, f"{place}/{n}")
            return known
    raise RuntimeError(f"closure did not settle in {max_rounds} rounds")


def reaching(edges: DataFrame, goal: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 10_000) -> DataFrame:
    """The distinct nodes (``node``) that edges lead from to a node of ``goal`` (``node``), the goal's own among them."""
    known = delta = cut(goal.select("node").distinct(), "reach")
    back = cut(edges.select(F.col(src).alias("from"), F.col(dst).alias("node")).distinct(), "reach-edges")
    for _ in range(max_rounds):
        new = back.join(delta, "node", "left_semi").select(F.col("from").alias("node")).where("node IS NOT NULL").distinct()
        delta = cut(new.join(known, "node", "left_anti"), "reach")
        if delta.isEmpty():
            return known
        known = known.union(delta)
    raise RuntimeError(f"the search did not settle in {max_rounds} rounds")
