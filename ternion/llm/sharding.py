"""Minimax contiguous partition of ordered atomic groups into shards.

Groups (equal texts) stand in the order of their smallest doc_id. The smallest capacity for which greedy
filling needs no more than the given number of shards is found by binary search. The prefix sums of the
groups stay distributed: the driver knows only some of them ("knots"), with which a greedy check gives
"surely feasible", "surely not" or "open". While the search is open, finer knots are fetched for just the
ranges in which a cut can fall, at most `KNOTS` of them a pass, so what reaches the driver is bounded by
that parameter at any input size and every pass narrows the ranges by orders of magnitude.

Nulls and edge cases: a null text has no bytes and all null texts form one group; empty texts form another;
repeated rows each get a slot of their own; a null doc_id sorts first; other columns are ignored; an empty
table gives no rows. Where a single group exceeds the mean, it has a shard to itself and others may be
empty.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ternion.plans.lineage import cut

SHARDS, OVERHEAD, KNOTS = 40, 16, 65536


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the sizes from the task's first row on, with the task's number."""
    total, pid = 0, TaskContext.get().partitionId()
    for batch in batches:
        upto = np.cumsum(np.asarray(batch.column("size"), np.int64)) + total
        if len(upto):
            total = int(upto[-1])
        yield pa.RecordBatch.from_arrays(
            [batch.column("digest"), pa.array(upto), pa.array(np.full(len(upto), pid, np.int32))], ["digest", "upto", "pid"]
        )


def _prefix_sums(groups: DataFrame) -> DataFrame:
    """``(digest, upto)``: the size of all groups up to and with this one, in order."""
    n = max(1, int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = (
        groups.repartitionByRange(n, "first_id", "digest")
        .sortWithinPartitions("first_id", "digest")
        .select("digest", "size")
        .mapInArrow(_running, "digest binary, upto long, pid int")
    )
    parts = cut(parts, "shard-groups")
    ends = parts.groupBy("pid").agg(F.max("upto").alias("all"))
    before = ends.select("pid", (F.sum("all").over(Window.orderBy("pid")) - F.col("all")).alias("base"))  # a row a task
    return cut(parts.join(F.broadcast(before), "pid").select("digest", (F.col("upto") + F.col("base")).alias("upto")), "shard-sums")


class _Known:
    """What the driver knows of the prefix sums: cells with their first and last sum; open ones hold more."""

    def __init__(self, cells: list[tuple[int, int, bool]]):
        self.cells = sorted(cells)
        self.first = [c[0] for c in self.cells]

    def cut(self, limit: int) -> tuple[int, int]:
        """The largest prefix sum up to ``limit``, at least and at most."""
        i = bisect_right(self.first, limit) - 1
        if i < 0:
            return 0, 0
        first, last, more = self.cells[i]
        if limit >= last:
            return last, last
        return (first, limit) if more else (first, first)

    def greedy(self, capacity: int, shards: int) -> tuple[list[int], list[int]]:
        low, high = [0], [0]
        for _ in range(shards):
            low.append(self.cut(low[-1] + capacity)[0])
            high.append(self.cut(high[-1] + capacity)[1])
        return low[1:], high[1:]

    def within(self, spans: list[tuple[int, int]]) -> list[tuple[int, int, bool]]:
        """Open cells that meet any of the spans."""
        found = {}
        for a, b in spans:
            i = max(0, bisect_right(self.first, a) - 1)
            while i < len(self.cells) and self.cells[i][0] <= b:
                if self.cells[i][2] and self.cells[i][1] >= a:
                    found[i] = self.cells[i]
                i += 1
        return [found[i] for i in sorted(found)]


def _finer(sums: DataFrame, cells: list[tuple[int, int, bool]], budget: int) -> list[tuple[int, int, bool]]:
    """The given cells, each cut into equal parts: about ``budget`` parts in all."""
    per = max(2, budget // len(cells))
    first, last = (np.array([c[k] for c in cells], np.int64) for k in (0, 1))
    step = -(-(last - first + 1) // per)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u = np.asarray(batch.column("upto"), np.int64)
            k = np.searchsorted(first, u, "right") - 1
            inside = (k >= 0) & (u <= last[k])
            u, k = u[inside], k[inside]
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array((u - first[k]) // step[k]), pa.array(u)], ["k", "part", "upto"])

    rows = (
        sums.select("upto")
        .mapInArrow(locate, "k long, part long, upto long")
        .groupBy("k", "part")
        .agg(F.min("upto").alias("lo"), F.max("upto").alias("hi"), F.count(F.lit(1)).alias("n"))
        .collect()  # two rows a part at most
    )
    return [(r["lo"], r["hi"], r["n"] > 2 and r["hi"] - r["lo"] > 1) for r in rows]


def _capacity(sums: DataFrame, total: int, largest: int, shards: int, budget: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity and the cuts it leads to."""
    bottom, top = max(largest, -(-total // shards)) - 1, total  # not feasible; feasible
    known = _Known(_finer(sums, [(0, total, True)], budget))
    while True:
        while top - bottom > 1:
            middle = (bottom + top) // 2
            low, high = known.greedy(middle, shards)
            if low[-1] >= total:
                top = middle
            elif high[-1] < total:
                bottom = middle
            else:
                break
        low, high = known.greedy(bottom + 1, shards)[0], known.greedy(top, shards)[1]
        todo = known.within(list(zip(low, high, strict=True)))
        if not todo:
            if top - bottom == 1:
                return top, known.greedy(top, shards)[0]
            raise AssertionError("an open search without open cells")
        gone = set(todo)
        known = _Known([c for c in known.cells if c not in gone] + _finer(sums, todo, budget))


def minimax_shards(docs: DataFrame, shards: int = SHARDS, overhead: int = OVERHEAD, knots: int = KNOTS) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` for every row; equal texts share a shard."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.when(F.col("text").isNull(), F.lit("00")).otherwise(F.md5(text.cast("binary")))).alias("digest"),
    )
    rows = cut(rows, "shard-rows")
    groups = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.sum("size").alias("size"))
    groups = cut(groups, "shard-sizes")
    stats = groups.agg(F.sum("size").alias("total"), F.max("size").alias("largest")).first()
    if not stats["total"]:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    sums = _prefix_sums(groups)
    _, cuts = _capacity(sums, stats["total"], stats["largest"], shards, knots)
    shard = F.lit(0)
    for edge in cuts[:-1]:
        shard = shard + (F.col("upto") > F.lit(edge)).cast("int")
    placed = rows.join(sums.select("digest", shard.alias("shard")), "digest")
    return _slots(placed)


def _slots(placed: DataFrame) -> DataFrame:
    """Number the rows of each shard from 0 without gaps, by doc_id."""
    n = max(1, int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["shard", "doc_id", "digest"]
    dealt = placed.repartitionByRange(n, *order).sortWithinPartitions(*order)
    dealt = cut(dealt.select("doc_id", "size", "text_crc32", "shard", F.monotonically_increasing_id().alias("at")), "shard-order")
    task = F.shiftright("at", 33)
    dealt = dealt.withColumn("pid", task)
    runs = dealt.groupBy("shard", "pid").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    base = runs.select("shard", "pid", "first", (F.sum("n").over(Window.partitionBy("shard").orderBy("pid")) - F.col("n")).alias("base"))
    return dealt.join(base, ["shard", "pid"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("at") - F.col("first") + F.col("base")).alias("slot")
    )
