"""Mixing sources to target weights by hierarchical budgeting, with DataFrame functions only.

Leaves are the distinct paths of the given levels (domain, language, source). A token budget flows from the
root down: among the children of a node it is split by their weights, but no child gets more than the
tokens its whole subtree can give (tokens of its leaves times ``max_epochs``). What a child cannot take goes
to its siblings by their weights, and only what no sibling can take is missing at the node, where it has
already been offered to the node's own siblings. Splitting is exact integer water-filling: with siblings in
the order of capacity per weight, a child is full when the rest of the budget at its rate would exceed its
capacity. Each leaf then takes whole epochs and a prefix of one more, in the order of a seeded digest of
epoch and doc_id; the prefix ends before the document that would exceed the leaf's share.

The order within a leaf is cut into 4096 cells by the digest's first three hex digits. Cells are summed
before anything is ordered, and only the one cell in which a leaf's prefix ends is sorted, so a source with a
third of all rows is never gathered anywhere.

Nulls and edge cases: null levels form paths of their own under the name ``''``; a null text and a text
without words have no tokens and are taken whenever their leaf gives a whole epoch or their place lies in its
prefix; a null doc_id sorts first; rows with equal doc_id in a leaf share their place and come or go
together; a level value without a weight has ``default_weight``; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ternion.plans.lineage import cut

LEVELS = ("domain", "lang", "source")
#: Integer weights of the values of each level; a value that is not named has DEFAULT_WEIGHT.
WEIGHTS: dict[str, dict[str, int]] = {"domain": {"d0": 40, "d1": 30, "d2": 20, "d3": 10}, "lang": {"en": 50, "de": 20, "fr": 20, "es": 10}}
DEFAULT_WEIGHT, SHARE_PERCENT, MAX_EPOCHS, SEED = 10, 60, 2, "mix-7"
DIGITS = 3
_INT = "decimal(38,0)"


def tokens() -> Column:
    """Words of ``text``: runs of bytes other than ASCII white space."""
    return F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def domain_of_source() -> Column:
    """The corpus has no domain column: a source's number modulo 4 stands for its domain."""
    return F.concat(F.lit("d"), F.coalesce(F.expr("try_cast(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 4"), F.lit(0)).cast("string"))


def _place(seed: str, epoch: Column) -> Column:
    """The place of a document in the seeded order of an epoch."""
    return F.md5(F.concat(F.lit(seed + "-"), epoch.cast("string"), F.lit("-"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def budgets(
    leaves: DataFrame, budget: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]], default_weight: int, max_epochs: int
) -> DataFrame:
    """``leaves`` (levels, ``tokens``) with ``share``: the tokens each leaf has to give. ``budget``: one row, ``b``.

    Each level reads the leaves once and takes only nodes from the level above, so that the plan, which the driver
    holds and compiles, grows with the levels and does not double with each.
    """
    caps = leaves.withColumn("cap", (F.col("tokens") * max_epochs).cast(_INT))
    above = budget.select(F.col("b").cast(_INT))
    for depth, level in enumerate(levels):
        names = weights.get(level, {})
        weight = F.lit(default_weight)
        for name, w in names.items():
            weight = F.when(F.col(level) == name, F.lit(w)).otherwise(weight)
        path, parent = list(levels[: depth + 1]), list(levels[:depth])
        nodes = caps.groupBy(*path).agg(F.sum("cap").cast(_INT).alias("c")).join(above, parent or None).withColumn("w", weight.cast(_INT))
        by = Window.partitionBy(*parent).orderBy((F.col("c").cast("double") / F.col("w").cast("double")), *path)
        before, after = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        nodes = (
            nodes.where("w > 0")
            .withColumn("cb", F.coalesce(F.sum("c").over(before), F.lit(0)).cast(_INT))
            .withColumn("wa", F.sum("w").over(after).cast(_INT))
            .withColumn("full", (F.col("b") - F.col("cb")) * F.col("w") >= F.col("c") * F.col("wa"))
            .withColumn("rank", F.row_number().over(by))
        )
        every = Window.partitionBy(*parent)
        nodes = (
            nodes.withColumn("fc", F.coalesce(F.sum(F.when(F.col("full"), F.col("c"))).over(every), F.lit(0)).cast(_INT))
            .withColumn("ow", F.coalesce(F.sum(F.when(~F.col("full"), F.col("w"))).over(every), F.lit(0)).cast(_INT))
            .withColumn(
                "s",
                F.when(F.col("full"), F.col("c"))
                .otherwise(F.expr("((b - fc) * w) div nullif(ow, 0)"))
                .cast(_INT),
            )
        )
        above = nodes.select(*path, F.col("s").alias("b"))
    return leaves.join(above.withColumnRenamed("b", "share"), list(levels)).withColumn("share", F.col("share").cast("long"))


def mix(
    docs: DataFrame,
    levels: Sequence[str] = LEVELS,
    weights: Mapping[str, Mapping[str, int]] | None = None,
    default_weight: int = DEFAULT_WEIGHT,
    share_percent: int = SHARE_PERCENT,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``(doc_id, *levels, tokens, epochs, *carry)`` of the documents taken once at least.

    ``epochs`` says how often. The budget is ``share_percent`` of all tokens. ``docs`` has the levels as
    columns; ``carry`` names columns to keep.
    """
    named = docs.select("doc_id", *[F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x) for x in levels], tokens().alias("tokens"), *[F.col(c).alias(f"_k_{c}") for c in carry])
    leaves = cut(named.groupBy(*levels).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n")), "mix-leaves")
    budget = leaves.agg(F.expr(f"CAST(sum(tokens) * {share_percent} AS DECIMAL(38,0)) div 100").alias("b"))
    plan = budgets(leaves, budget, levels, weights or WEIGHTS, default_weight, max_epochs)
    plan = cut(
        plan.select(
            *levels,
            F.expr("CASE WHEN tokens > 0 THEN share div tokens ELSE 1 END").alias("whole"),
            F.expr("CASE WHEN tokens > 0 THEN share % tokens ELSE 0 END").alias("rest"),
        ),
        "mix-plan",
    )
    placed = named.join(plan, list(levels)).withColumn("place", _place(seed, F.col("whole")))
    placed = placed.withColumn("cell", F.substring("place", 1, DIGITS))
    cells = placed.groupBy(*levels, "cell").agg(F.sum("tokens").alias("t"), F.first("rest").alias("rest"))
    upto = Window.partitionBy(*levels).orderBy("cell")
    cells = cells.withColumn("base", F.sum("t").over(upto) - F.col("t"))
    ends = cut(
        cells.where("base + t > rest").groupBy(*levels).agg(F.min(F.struct("cell", "base")).alias("x")).select(*levels, F.col("x.cell").alias("end_cell"), F.col("x.base").alias("base")),
        "mix-ends",
    )
    marked = placed.join(ends, list(levels), "left")
    inner = (
        marked.where("cell = end_cell")
        .groupBy(*levels, "place")
        .agg(F.sum("tokens").alias("t"), F.first("base").alias("base"), F.first("rest").alias("rest"))
        .withColumn("upto", F.sum("t").over(Window.partitionBy(*levels).orderBy("place")) + F.col("base"))
        .where("upto <= rest")
        .select(*levels, F.col("place"), F.lit(1).alias("inside"))
    )
    inner = cut(inner, "mix-inner")
    out = marked.join(inner, [*levels, "place"], "left")
    extra = F.when(F.col("end_cell").isNull() | (F.col("cell") < F.col("end_cell")) | F.col("inside").isNotNull(), 1).otherwise(0)
    extra = F.when(F.col("whole") >= max_epochs, 0).otherwise(extra)
    return (
        out.withColumn("epochs", (F.col("whole") + extra).cast("long"))
        .where("epochs > 0")
        .select("doc_id", *levels, "tokens", "epochs", *[F.col(f"_k_{c}").alias(c) for c in carry])
    )
