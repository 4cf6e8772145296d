"""Entity resolution: surfaces, blocking, similarity, clusters, canonical names, rewriting."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ternion.functions import text as T
from ternion.functions.similarity import cosine, jaccard
from ternion.operators.components import connected_components

SAME, EXACT_UP_TO, CANDIDATES, MIXED_LEAST, COSINE_SHARE = 0.88, 350, 40, 0.55, 0.35
#: Names of one token that meet in a task; rows of a block of vectors, of which so many are multiplied at a time.
TOKEN_NAMES, BLOCK, STRIP = 4096, 8192, 256


def surface_groups(items: DataFrame, *by: str) -> DataFrame:
    """``(*by, name, rep)``; names of one normal form share the one that starts upper, has most capitals, is longest, comes first."""
    key = [*by, "norm"]
    capitals = F.length(F.regexp_replace("name", "[^A-Z]", ""))
    order = [F.col("name").rlike("^[A-Z]").desc(), capitals.desc(), F.char_length("name").desc(), F.col("name").asc()]
    normed = items.select(*by, "name").distinct().withColumn("norm", T.surface_norm(F.col("name")))
    return normed.withColumn("rep", F.first("name").over(Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).drop("norm")


def exact_pairs(items: DataFrame) -> DataFrame:
    """All pairs ``a < b`` with one new name at least, for universes up to `EXACT_UP_TO`; more rows are an error.

    ``items`` has name, is_new, vec.
    """
    n = items.limit(EXACT_UP_TO + 1).count()
    if n > EXACT_UP_TO:
        raise ValueError(f"more than {EXACT_UP_TO} names: use blocked_pairs")
    a, b = items.alias("a"), items.alias("b")
    return a.join(b, (F.col("a.name") < F.col("b.name")) & (F.col("a.is_new") | F.col("b.is_new"))).select(F.col("a.name").alias("a"), F.col("b.name").alias("b"), cosine(F.col("a.vec"), F.col("b.vec")).alias("cosine"))


def blocked_pairs(items: DataFrame, least: float = MIXED_LEAST, cap: int = CANDIDATES) -> DataFrame:
    """Pairs that share a blocking token and score Jaccard + 0.35 cosine >= ``least``; the best ``cap`` of each name."""
    tokened = items.withColumn("tokens", T.block_tokens(F.col("name")))
    # A token with very many names is dealt to parts by one side's name; the other side goes to each part.
    posted = tokened.select("name", F.explode("tokens").alias("token"))
    sizes = posted.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / TOKEN_NAMES).cast("int").alias("parts"))
    sized = posted.join(sizes, "token")
    one = sized.select(F.col("name").alias("x"), "token", F.pmod(F.xxhash64("name"), F.col("parts")).cast("int").alias("part"))
    other = sized.select(F.col("name").alias("y"), "token", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    pairs = one.join(other, ["token", "part"]).where("x <> y").select("x", "y").distinct()
    left = tokened.select(F.col("name").alias("x"), F.col("tokens").alias("tx"), F.col("vec").alias("vx"), F.col("is_new").alias("nx"))
    right = tokened.select(F.col("name").alias("y"), F.col("tokens").alias("ty"), F.col("vec").alias("vy"), F.col("is_new").alias("ny"))
    scored = pairs.join(left, "x").join(right, "y").withColumn("cosine", cosine(F.col("vx"), F.col("vy"))).withColumn("score", jaccard(F.col("tx"), F.col("ty")) + COSINE_SHARE * F.col("cosine"))
    best = Window.partitionBy("x").orderBy(F.desc("score"), F.desc("y"))
    kept = scored.where(F.col("score") >= least).withColumn("rn", F.row_number().over(best)).where((F.col("rn") <= cap) & (F.col("nx") | F.col("ny")))
    return kept.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "cosine", "score").dropDuplicates(["a", "b"])


def candidate_pairs(items: DataFrame) -> DataFrame:
    """Exact up to `EXACT_UP_TO` names, blocked beyond."""
    return exact_pairs(items) if items.limit(EXACT_UP_TO + 1).count() <= EXACT_UP_TO else blocked_pairs(items).drop("score")


def decide(pairs: DataFrame, threshold: float = SAME) -> DataFrame:
    """G2."""
    return pairs.withColumn("same", F.col("cosine") >= threshold)


def clusters(items: DataFrame, decisions: DataFrame) -> DataFrame:
    """G1: ``(name, cluster)``, the smallest name of each component; names without links stand alone."""
    comp = connected_components(decisions.where("same"), "a", "b").withColumnRenamed("node", "name")
    return items.select("name").distinct().join(comp, "name", "left").select("name", F.coalesce("component", "name").alias("cluster"))


def disband(members: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Clusters judged not the same become single names; no verdict keeps a cluster. ``verdicts``: cluster, same."""
    return members.join(verdicts, "cluster", "left").select("name", F.when(~F.coalesce("same", F.lit(True)), F.col("name")).otherwise(F.col("cluster")).alias("cluster"))


def conflicts(members: DataFrame, decisions: DataFrame) -> DataFrame:
    """Pairs decided different that nevertheless stand in one cluster."""
    a = members.select(F.col("name").alias("a"), F.col("cluster").alias("ca"))
    b = members.select(F.col("name").alias("b"), F.col("cluster").alias("cb"))
    return decisions.where(~F.col("same")).join(a, "a").join(b, "b").where("ca = cb").select("a", "b", F.col("ca").alias("cluster"))


def canonical_names(members: DataFrame, known: DataFrame) -> DataFrame:
    """Per cluster the smallest known canonical name, else the shortest (then smallest) name. ``known``: name."""
    marked = members.join(known.select("name", F.lit(True).alias("k")).distinct(), "name", "left")
    best = marked.groupBy("cluster").agg(F.min(F.when(F.col("k"), F.col("name"))).alias("kn"), F.min_by("name", F.struct(F.char_length("name"), F.col("name"))).alias("sn"))
    return members.join(best.select("cluster", F.coalesce("kn", "sn").alias("canonical")), "cluster").select("name", "cluster", "canonical")


def honour_prior(mapped: DataFrame, prior: DataFrame) -> DataFrame:
    """Names mapped before keep that canonical name. ``prior``: surface, canonical."""
    p = prior.select(F.col("surface").alias("name"), F.col("canonical").alias("pc"))
    return mapped.join(p, "name", "left").withColumn("canonical", F.coalesce("pc", "canonical")).drop("pc")


def rewrite(t: DataFrame, entities: DataFrame, relations: DataFrame) -> DataFrame:
    """Subjects and predicates, and objects that are no literals, by their canonical names. Maps: name, canonical."""
    maps = {"subject": entities, "predicate": relations, "object": entities}
    out = t
    for c, m in maps.items():
        new = F.col("_to") if c != "object" else F.when(~T.is_literal(F.col(c)), F.col("_to"))
        out = out.join(m.select(F.col("name").alias(c), F.col("canonical").alias("_to")), c, "left").withColumn(c, F.coalesce(new, F.col(c))).drop("_to")
    return out.select(*t.columns)


def linking_stats(pairs: DataFrame, members: DataFrame, category: str, mode: str) -> DataFrame:
    """One row of counts for a category."""
    c = pairs.agg(F.count(F.lit(1)).alias("compared"), F.count_if("same").alias("same"))
    m = members.agg(F.count(F.lit(1)).alias("total"), F.count_distinct("cluster").alias("clusters"))
    n = conflicts(members, pairs).agg(F.count(F.lit(1)).alias("conflicts"))
    return c.crossJoin(m).crossJoin(n).select(F.lit(category).alias("category"), F.lit(mode).alias("mode"), "total", "compared", "same", "clusters", "conflicts")


def _blocks(df: DataFrame, n: int) -> DataFrame:
    return df.withColumn("_block", F.pmod(F.xxhash64("name", "vec"), F.lit(n)).cast("int"))


def _vectors(df: DataFrame) -> DataFrame:
    """Names with vectors of doubles, as columns of their own, since a table may meet itself."""
    return df.select(F.col("name").alias("name"), F.col("vec").cast("array<double>").alias("vec"))


def similar(left: DataFrame, right: DataFrame, least: float | None = None, k: int | None = None) -> DataFrame:
    """``(a, b, score)``: cosines of the rows of ``left`` with those of ``right`` (name, vec), pairs of one name left out.

    With ``least`` only cosines from there up, with ``k`` only the ``k`` best that each block of ``right`` has for a row
    (ties to the larger name). Blocks of bounded size meet, a pair of blocks in a task, as one matrix product in strips;
    only what is kept leaves the task. Empty, zero and unequally long vectors have cosine 0, as in `cosine`.
    """
    n, m = (max(1, -(-x.count() // BLOCK)) for x in (left, right))
    a = _blocks(_vectors(left), n).withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
    b = _blocks(_vectors(right), m).withColumnRenamed("_block", "_other").withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    by = ["_block", "_other"]
    return a.groupBy(*by).cogroup(b.groupBy(*by)).applyInArrow(lambda u, v: _meet(u, v, least, k, False), "a string, b string, score double")


def similar_pairs(items: DataFrame, least: float) -> DataFrame:
    """``(a, b, score)``: the pairs of ``items`` (name, vec) with a cosine of ``least`` or more, each once, pairs of one name left out.

    As `similar`, but two blocks meet once and not once from either side.
    """
    n = max(1, -(-items.count() // BLOCK))
    a = _blocks(_vectors(items), n).withColumn("_other", F.explode(F.sequence(F.col("_block"), F.lit(n - 1))))
    b = _blocks(_vectors(items), n).withColumnRenamed("_block", "_other").withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_other"))))
    by = ["_block", "_other"]

    def meet(key: tuple, u: pa.Table, v: pa.Table) -> pa.Table:
        return _meet(u, v, least, None, key[0].as_py() == key[1].as_py())

    return a.groupBy(*by).cogroup(b.groupBy(*by)).applyInArrow(meet, "a string, b string, score double")


def _meet(x: pa.Table, y: pa.Table, least: float | None, k: int | None, same: bool) -> pa.Table:
    """The kept pairs of two blocks. ``same``: both hold the same rows, of which pairs are kept once."""
    out: list[list] = [[np.empty(0, int)], [np.empty(0, int)], [np.empty(0)]]
    one, other = (t.column("name").combine_chunks() for t in (x, y))
    if x.num_rows and y.num_rows:
        names, code = np.unique(np.array(one.to_pylist() + other.to_pylist(), object), return_inverse=True)
        ca, cb = code[: len(one)], code[len(one) :]
        order = np.argsort(-cb, kind="stable")  # larger names first
        cb = cb[order]
        u, v = _unit(x.column("vec")), {d: w[order] for d, w in _unit(y.column("vec")).items()}
        dims = [d for d in u if d in v]
        place = np.empty(len(ca), int)
        if same:  # a row's place among the other side's rows
            place[np.argsort(-ca, kind="stable")] = np.arange(len(ca))
        for at in range(0, len(ca), STRIP):
            to = min(at + STRIP, len(ca))
            score = u[dims[0]][at:to] @ v[dims[0]].T if dims else np.zeros((to - at, len(cb)))
            for d in dims[1:]:
                score += u[d][at:to] @ v[d].T
            if k is None:
                r, c = np.nonzero(score >= least) if least is not None else np.nonzero(np.ones(score.shape, bool))
                keep = (ca[at + r] != cb[c]) & ((place[at + r] < c) if same else True)
                r, c = r[keep], c[keep]
            else:
                far = np.where(np.isnan(score), np.inf, -score)
                far[ca[at:to, None] == cb[None, :]] = np.inf
                if least is not None:
                    far[~(score >= least)] = np.inf
                kth = np.partition(far, min(k, len(cb)) - 1, axis=1)[:, min(k, len(cb)) - 1]
                r, c = np.nonzero(far <= kth[:, None])
                keep = ca[at + r] != cb[c]
                if least is not None:
                    keep &= score[r, c] >= least
                r, c = r[keep], c[keep]
                best = np.lexsort((c, far[r, c], r))
                r, c = r[best], c[best]
                first = np.searchsorted(r, r)
                r, c = (z[np.arange(len(r)) - first < k] for z in (r, c))
            out[0].append(at + r)
            out[1].append(order[c])
            out[2].append(score[r, c])
    i, j, found = (np.concatenate(z) for z in out)
    return pa.table({"a": one.take(pa.array(i)), "b": other.take(pa.array(j)), "score": pa.array(found, pa.float64())})


def _unit(column: pa.ChunkedArray) -> dict[int, np.ndarray]:
    """Unit vectors by dimension, a row for every vector (zeros where it has another dimension or no length)."""
    whole = column.combine_chunks()
    sizes = np.asarray(pc.fill_null(pc.list_value_length(whole), 0), np.int64)
    values = np.asarray(pc.fill_null(whole.flatten(), float("nan")), np.float64)
    starts, out = np.cumsum(sizes) - sizes, {}
    for d in sorted(set(sizes.tolist()) - {0}):
        rows = np.flatnonzero(sizes == d)
        m = np.zeros((len(sizes), d))
        m[rows] = values[starts[rows, None] + np.arange(d)]
        size = np.sqrt((m * m).sum(1))
        out[d] = m / np.where(size > 0, size, 1.0)[:, None]
    return out


def knn(queries: DataFrame, pool: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` most similar labelled names of each query. ``queries``: name, vec; ``pool``: name, kind, vec.

    Every query stands against the whole pool, block by block; a block gives k rows a query. Ties go to the larger name.
    """
    p = pool.select(F.col("name").alias("b"), "kind")
    scored = similar(queries, pool, k=k).join(p, "b").select(F.col("a").alias("name"), F.col("b").alias("near"), "kind", "score")
    by = Window.partitionBy("name").orderBy(F.desc("score"), F.desc("near"), F.desc("kind"))
    return scored.withColumn("rank", F.row_number().over(by).cast("long")).where(F.col("rank") <= k)


def new_names(found: DataFrame, prior: DataFrame) -> DataFrame:
    """Distinct names (``name``) without a canonical name from before."""
    return found.select("name").distinct().join(prior.select("name").distinct(), "name", "left_anti")


def universe(new: DataFrame, known: DataFrame) -> DataFrame:
    """``(name, is_new)``: the new names and the known canonical ones, each once; a name that is both is new."""
    both = new.select("name", F.lit(True).alias("is_new")).unionByName(known.select("name", F.lit(False).alias("is_new")))
    return both.groupBy("name").agg(F.bool_or("is_new").alias("is_new"))


def zipped(batches: DataFrame, default: str) -> DataFrame:
    """``(name, answer)`` of batches (``names``, ``answers``) by position; names beyond the answers get ``default``, answers beyond the names go."""
    pairs = F.transform("names", lambda x, i: F.struct(x.alias("name"), F.coalesce(F.get("answers", i), F.lit(default)).alias("answer")))
    return batches.select(F.explode(pairs).alias("x")).select("x.*")
