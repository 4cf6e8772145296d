"""Approximate nearest neighbours by adaptive dimension scans of probed lists.

Largest inner product is turned into smallest Euclidean distance by one more component, sqrt(M^2 - |v|^2)
(0 for queries; M the largest norm). Vectors are rotated by a fixed random orthogonal matrix and dealt to
the lists of a k-means fitted on a bounded sample; every vector is indexed. A query probes its nearest
lists. Within a list, vectors are held in blocks of columns: after each block of dimensions the partial
distance, scaled up by the share of dimensions seen, is tested against the query's current k-th distance,
and candidates whose distance exceeds it beyond the test's error bound are abandoned. Rotation makes the
partial distance an unbiased estimate, so the bound holds with a probability set by ``CONFIDENCE``. Survivors
are scored exactly on the original vectors in double precision.

Lists stand on ``SHELVES`` shelves, and a query goes once to each shelf that holds a list it probes. A shelf is
cut into salted parts and its queries into salted blocks, each of bounded size, so a list with a third of all
vectors is many tasks. Each part gives at most k candidates per query, and the best k of these
are chosen after partial selection.

Sample: at most ``SAMPLE`` vectors, the smallest by hashed id, for k-means and the probes alone. Lists grow with the square root of
the rows, from ``LISTS`` (fewer below ``LIST_ROWS`` rows a list) to a list for every ``LIST_ROWS`` sampled vectors. How many of
them a query probes is measured: as many as hold a share ``PROBED`` of the true neighbours of ``ASKED`` sampled vectors
within the sample. Clustered vectors need few lists; where the neighbours lie in all directions, as with nearly isotropic ones,
most of them, and the work grows with the product of queries and rows. A query's first bound is its distance to
the (2k+2)-th nearest of at most ``ANCHORS`` sampled vectors that lie in its probed lists. Centroids, anchors and norms are the only broadcast data, bounded by these.

Nulls and edge cases: vectors null, empty, zero, with null or non-finite components, or of a dimension other
than the commonest take no part; neither do null ids; repeated rows with one id and vector are one; ids with
several vectors keep the smallest; a query without candidates gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ternion.llm import textbytes as tb
from ternion.plans.lineage import cut

K, SAMPLE, ANCHORS, LISTS, SHELVES, LIST_ROWS, PROBED, ASKED, COLUMNS, CONFIDENCE, PART_ROWS, QUERY_ROWS, SEED = 20, 20_000, 2048, 64, 8, 8, 0.97, 512, 16, 2.1, 65_536, 32_768, 7


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, v)``: one finite nonzero vector in doubles per id, all of the commonest dimension."""
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where("id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    rows = rows.where(fine)
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.size("v") == (size["n"] if size else -1))
    return rows.groupBy("id").agg(F.min("v").alias("v"))


def _matrix(column) -> np.ndarray:
    n = len(column)
    values = np.asarray(column.flatten(), np.float64)
    return values.reshape(n, -1) if n else np.zeros((0, 0))


def _rotation(n: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((n, n)))
    return q * np.sign(np.diag(r))


def _lift(v: np.ndarray, most: float, query: bool) -> np.ndarray:
    last = np.zeros(len(v)) if query else np.sqrt(np.maximum(most * most - (v * v).sum(1), 0.0))
    return np.c_[v, last]


def kmeans(x: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's rounds from seeded distinct rows."""
    x = np.unique(x, axis=0)
    rng = np.random.default_rng(SEED)
    c = x[rng.choice(len(x), min(lists, len(x)), replace=False)]
    for _ in range(rounds):
        near = nearest(x, c)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=len(c))
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def nearest(x: np.ndarray, c: np.ndarray, k: int = 1) -> np.ndarray:
    """Indices of the ``k`` nearest rows of ``c``."""
    out = []
    for a in range(0, len(x), 2048):
        d = (c * c).sum(1)[None] - 2 * x[a : a + 2048] @ c.T
        out.append(d.argmin(1) if k == 1 else np.argpartition(d, k - 1, axis=1)[:, :k] if k < len(c) else np.broadcast_to(np.arange(len(c)), d.shape))
    return np.concatenate(out) if out else np.zeros((0,) if k == 1 else (0, k), np.int64)


def scan(q: np.ndarray, x: np.ndarray, k: int, far: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of ``q``, row of ``x``) that may be among the ``k`` nearest: partial distances by column blocks.

    ``far`` holds squared distances, one per query, beyond which nothing is wanted.
    """
    n, dims = x.shape
    if n <= k:
        return np.repeat(np.arange(len(q)), n), np.tile(np.arange(n), len(q))
    seed = x[: min(n, max(2 * k, 64))]
    whole = (q * q).sum(1)[:, None] - 2 * q @ seed.T + (seed * seed).sum(1)[None]
    bound = np.maximum(np.partition(whole, k - 1, axis=1)[:, k - 1], 0.0) * (1 + 1e-9) + 1e-9
    if far is not None:
        bound = np.minimum(bound, far)
    b = min(COLUMNS, dims)
    partial = (q[:, :b] ** 2).sum(1)[:, None] - 2 * q[:, :b] @ x[:, :b].T + (x[:, :b] ** 2).sum(1)[None]
    who, at = np.nonzero(partial <= (bound * _reach(b, dims))[:, None])
    partial = partial[who, at]
    for a in range(b, dims, COLUMNS):
        b = min(dims, a + COLUMNS)
        partial = partial + ((x[at, a:b] - q[who, a:b]) ** 2).sum(1)
        keep = partial <= bound[who] * _reach(b, dims)
        who, at, partial = who[keep], at[keep], partial[keep]
    return who, at


def first_bound(q: np.ndarray, probed: np.ndarray, anchor: np.ndarray, home: np.ndarray, lists: int, rank: int) -> np.ndarray:
    """Squared distance of each query to its ``rank``-th nearest anchor in the lists it probes; infinite if there are fewer."""
    out = np.full(len(q), np.inf)
    if len(anchor) < rank:
        return out
    own = (anchor * anchor).sum(1)[None]
    for a in range(0, len(q), 512):
        part = q[a : a + 512]
        d = np.maximum((part * part).sum(1)[:, None] - 2 * part @ anchor.T + own, 0.0)
        inside = np.zeros((len(part), lists), bool)
        np.put_along_axis(inside, probed[a : a + 512], True, axis=1)
        d[~inside[:, home]] = np.inf
        out[a : a + 512] = np.partition(d, rank - 1, axis=1)[:, rank - 1] * (1 + 1e-9) + 1e-9
    return out


def probes(x: np.ndarray, c: np.ndarray, k: int, share: float) -> int:
    """How many nearest lists hold ``share`` of the ``k`` true neighbours of the first rows of ``x`` (lifted as candidates) among all rows."""
    asked, home, rank = x[:ASKED], nearest(x, c), np.zeros(0, np.int64)
    k = min(k, len(x) - 1)
    if not k:
        return len(c)
    for a in range(0, len(asked), 64):
        q = asked[a : a + 64]
        score = q[:, :-1] @ x[:, :-1].T  # the queries' own last component is 0
        score[np.arange(len(q)), a + np.arange(len(q))] = -np.inf
        best = np.argpartition(-score, k - 1, axis=1)[:, :k]
        d = (c * c).sum(1)[None] - 2 * np.c_[q[:, :-1], np.zeros(len(q))] @ c.T
        place = np.argsort(np.argsort(d, axis=1, kind="stable"), axis=1, kind="stable")
        rank = np.r_[rank, np.take_along_axis(place, home[best], axis=1).reshape(-1)]
    return int(np.quantile(rank, share, method="higher")) + 1 if len(rank) else len(c)


def _reach(seen: int, dims: int) -> float:
    """How far a partial distance over ``seen`` dimensions may go, as a share of the whole distance's bound."""
    return 1.0 if seen == dims else seen / dims * (1 + CONFIDENCE / np.sqrt(seen)) ** 2


def search(
    vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", probed: float = PROBED
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` largest inner products found, the query's own id left out."""
    spark = vectors.sparkSession
    base = cut(usable(vectors, id_col, vec_col), "ann-base")
    asked = cut(usable(queries, id_col, vec_col), "ann-queries")
    stats = base.agg(F.count(F.lit(1)).alias("n"), F.max(F.expr("aggregate(v, 0D, (s, x) -> s + x * x)")).alias("m"), F.max(F.size("v")).alias("d")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not stats["n"]:
        return empty
    most, dims = float(np.sqrt(stats["m"])), stats["d"] + 1
    turn = _rotation(dims)
    rows = base.orderBy(F.xxhash64("id")).limit(SAMPLE).select("v").toArrow()
    sample = _lift(_matrix(rows.column("v").combine_chunks()), most, False)
    lists = min(max(LISTS, int(np.sqrt(stats["n"]) / 8)), -(-len(sample) // LIST_ROWS))
    plain = kmeans(sample, lists)
    asking = probes(sample, plain, k, probed)
    centre, anchors = plain @ turn, sample[:ANCHORS] @ turn
    shared = spark.sparkContext.broadcast((centre, anchors, nearest(anchors, centre)))

    def deal(query: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c, anchor, home = shared.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _lift(_matrix(batch.column("v")), most, query) @ turn
                near = nearest(x, c, asking if query else 1).reshape(batch.num_rows, -1)
                if not query:
                    yield pa.RecordBatch.from_arrays([pa.array((near[:, 0] % SHELVES).astype(np.int32)), pa.array(near[:, 0].astype(np.int32)), batch.column("id"), batch.column("v")], ["shelf", "list", "id", "v"])
                    continue
                cell = np.arange(batch.num_rows)[:, None] * SHELVES + near % SHELVES
                order = np.argsort(cell.reshape(-1), kind="stable")
                count = np.bincount(cell.reshape(-1), minlength=batch.num_rows * SHELVES)
                full = np.flatnonzero(count)
                lists_of = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count[full])].astype(np.int32)), pa.array(near.reshape(-1)[order].astype(np.int32)))
                at = pa.array(full // SHELVES)
                far = first_bound(x, near, anchor, home, len(c), 2 * k + 2)[full // SHELVES]
                yield pa.RecordBatch.from_arrays([pa.array((full % SHELVES).astype(np.int32)), batch.column("id").take(at), batch.column("v").take(at), pa.array(far), lists_of], ["shelf", "id", "v", "far", "lists"])

        return run

    dealt = cut(base.mapInArrow(deal(False), "shelf int, list int, id long, v array<double>"), "ann-lists")
    sizes = cut(dealt.groupBy("shelf").count().select("shelf", F.ceil(F.col("count") / PART_ROWS).cast("int").alias("parts")), "ann-sizes")
    blocks = max(1, -(-asked.count() // QUERY_ROWS))
    members = dealt.join(F.broadcast(sizes), "shelf").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("parts").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))  # SHELVES rows at most
    wanted = asked.mapInArrow(deal(True), "shelf int, id long, v array<double>, far double, lists array<int>").join(F.broadcast(sizes.select("shelf", F.sequence(F.lit(0), F.col("parts") - 1).alias("all_parts"))), "shelf")
    wanted = wanted.select("shelf", "id", "v", "far", "lists", F.explode("all_parts").alias("part"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"))

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if left.num_rows and right.num_rows:
            ids = np.asarray(left.column("id").combine_chunks(), np.int64)
            home = np.asarray(left.column("list").combine_chunks(), np.int64)
            order = np.lexsort((ids, home))
            ids, home, v = ids[order], home[order], _matrix(left.column("v").combine_chunks())[order]
            names, first = np.unique(home, return_index=True)
            spans = list(zip(names.tolist(), first.tolist(), [*first[1:].tolist(), len(home)], strict=True))
            x = _lift(v, most, False) @ turn
            q_ids, q_v = np.asarray(right.column("id").combine_chunks(), np.int64), _matrix(right.column("v").combine_chunks())
            lifted, far = _lift(q_v, most, True) @ turn, np.asarray(right.column("far").combine_chunks(), np.float64)
            lists_of = right.column("lists").combine_chunks()
            probing = np.zeros((len(q_ids), lists), bool)
            probing[np.repeat(np.arange(len(q_ids)), np.diff(np.asarray(lists_of.offsets))), np.asarray(lists_of.flatten())] = True
            for a in range(0, len(q_ids), 256):
                hits = []
                for name, lo, hi in spans:
                    asking = np.flatnonzero(probing[a : a + 256, name])
                    who, at = scan(lifted[a + asking], x[lo:hi], k + 1, far[a + asking])
                    hits.append((asking[who], lo + at))
                who, at = (np.concatenate(z) for z in zip(*hits, strict=True))
                other = q_ids[a + who] != ids[at]
                who, at = who[other], at[other]
                score = (v[at] * q_v[a + who]).sum(1)
                best = np.lexsort((ids[at], -score, who))
                who, at, score = who[best], at[best], score[best]
                place = np.arange(len(who)) - np.searchsorted(who, who)
                keep = place < k
                out[0].append(q_ids[a + who[keep]])
                out[1].append(ids[at[keep]])
                out[2].append(score[keep])
        cols = [np.concatenate(x) if x else np.zeros(0) for x in out]
        return pa.table({"query_id": pa.array(cols[0].astype(np.int64)), "vec_id": pa.array(cols[1].astype(np.int64)), "score": pa.array(cols[2].astype(np.float64))})

    found = members.groupBy("shelf", "part", "block").cogroup(wanted.groupBy("shelf", "part", "block")).applyInArrow(look, "query_id long, vec_id long, score double")
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query_rows(vectors: DataFrame, id_col: str = "vec_id", every: int = 20) -> DataFrame:
    """The stated query set: rows whose id is divisible by ``every``."""
    return vectors.where(F.col(id_col) % every == 0)
