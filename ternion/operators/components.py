"""Connected components by alternating large-star and small-star steps.

Up to `FEW` edges between integers or strings are joined in the memory of one task instead, as a round's jobs cost
more than they do; the bound is fixed, whatever the input's size. Beyond it, every step is a grouped minimum (partially aggregated before the shuffle), written and then joined back to the
edges: as the join reads both sides through exchanges of its own, the adaptive plan splits a vertex with very many
neighbours among tasks. The number of steps grows with the logarithm of the largest component's diameter. Each step is
cut to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ternion.plans.lineage import cut

#: So many edges at most are joined by one task: some 40 MB of it for integers.
FEW = 200_000
_PLAIN = ("tinyint", "smallint", "int", "bigint", "string")


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def _least(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """The smallest number in the component of each of the numbers below ``n``."""
    label = np.arange(n)
    while True:
        a, b = label[u], label[v]
        if (a == b).all():
            return label
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of all edges of one task with their components."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    ends = pa.concat_arrays([b.column(c) for c in ("u", "v") for b in parts])
    nodes = ends.unique()
    nodes = nodes.take(pc.sort_indices(nodes))
    at = np.asarray(pc.index_in(ends, value_set=nodes), np.int64)
    least = _least(at[: len(at) // 2], at[len(at) // 2 :], len(nodes))
    yield pa.RecordBatch.from_arrays([nodes, nodes.take(pa.array(least))], ["node", "component"])


def _few(edges: DataFrame) -> DataFrame | None:
    """The components of written edges, if there are few of them."""
    kind = edges.schema["u"].dataType.simpleString()
    if kind not in _PLAIN or edges.count() > FEW:
        return None
    return cut(edges.coalesce(1).mapInArrow(_join, f"node {kind}, component {kind}"), "cc-joined")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """``(node, component)``: the smallest node of each component, for every node that has an edge.

    Self-loops and repeated edges are fine; edges with a null end are ignored; no edges give no rows.
    Ends may be of any orderable type.
    """
    pairs = (
        edges.select(F.col(src).alias("a"), F.col(dst).alias("b"))
        .where("a IS NOT NULL AND b IS NOT NULL")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    )
    pairs = cut(pairs, "cc-pairs")
    if (found := _few(pairs)) is not None:
        return found
    current = cut(pairs.distinct(), "cc-edges")
    if (found := _few(current)) is not None:
        return found
    loops = current.where("u = v").select(F.col("u").alias("node"), F.col("u").alias("component"))
    current = current.where("u <> v")
    seen = _state(current)
    if seen[0]:
        for _ in range(max_rounds):
            both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc-least")
            large = (
                both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
            )
            large = cut(large, "cc-large")
            low = cut(large.groupBy("u").agg(F.min("v").alias("m")), "cc-low")
            small = (
                large.join(low, "u")
                .where("v <> m")
                .select(F.col("v").alias("u"), F.col("m").alias("v"))
                .union(low.select("u", F.col("m").alias("v")))
                .distinct()
            )
            current = cut(small, "cc-small")
            now = _state(current)
            if now == seen:
                break
            seen = now
        else:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return stars.union(roots).union(loops).groupBy("node").agg(F.min("component").alias("component"))
