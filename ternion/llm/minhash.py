"""Near-duplicate documents by weighted MinHash over bags of word shingles.

Signature. Every (shingle, weight cell) carries a Poisson process of rate one; the signature's entry k is
the earliest point, over all cells below a document's multiplicities, that falls into slot k. Two
documents agree in an entry with probability sum(min)/sum(max), the weighted Jaccard similarity. The
processes are organised hierarchically: the weight axis is cut into the blocks [0,1), [1,2), [2,4),
[4,8), ..., each block has one process of its length's rate, and in the block that holds the
multiplicity itself points are kept by their position. Points are drawn in order of time up to a horizon
that fills all slots with high probability, and further for documents with empty slots, so a long
document costs one comparison per shingle and not one per shingle and slot.

Search. Bands of signature entries give buckets; in each bucket every member is compared with the
bucket's most connected member by exact multiset overlap of the texts; then, in each group that buckets connect and
that still has several components, the documents outside its largest component are compared with all of the group
exactly, block by block of bounded rows and bytes, and only links leave a task. So a text is copied once for every
`BLOCK` documents or `BLOCK_BYTES` outside that component, however large it is. No bucket is capped and no pair within a group is spelled out.
Equal texts are joined beforehand through a digest. Grouped counts are written before they are joined back, so the
rows of a very large group are split among tasks by the adaptive join.

Nulls and edge cases: a null text is a document of its own; texts without words are joined only with equal
texts; texts of one to four words have a single shingle; rows with a null doc_id are returned with a null
class; rows of one doc_id are one document, which stands for all its texts in buckets and for the smallest of them
in comparisons; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ternion.llm import textbytes as tb
from ternion.llm.tables import handing_back, small_batches
from ternion.operators.components import connected_components
from ternion.plans.lineage import cut

SIMILARITY, BANDS, ROWS, BLOCK, WIDE = 0.8, 20, 5, 512, 2048
#: Bytes of text of a block outside the largest component and of one of the whole group, besides their rows.
BLOCK_BYTES, WIDE_BYTES = 2 << 20, 8 << 20
_GOLD, _SLOT, _PLACE = 0x9E3779B97F4A7C15, 0xA0761D6478BD642F, tb.U(0xE7037ED1A0B428DB)
_MASK = (1 << 64) - 1
_UNIT = 2.0**-53


def _points(seed, rate, low, weight, owner, horizon, slots):
    """All points up to each owner's horizon that lie below the weight: (time, slot, hash, owner)."""
    time, n, out = np.zeros(len(seed)), 1, []
    while len(seed):
        z = tb.mix(seed + tb.U(n * _GOLD & _MASK))
        time = time - np.log1p(-((z >> tb.U(11)).astype(np.float64) + 0.5) * _UNIT) / rate
        live = time < horizon[owner]
        seed, rate, low, weight, owner, time, z = (x[live] for x in (seed, rate, low, weight, owner, time, z))
        place = low + ((tb.mix(z ^ _PLACE) >> tb.U(11)).astype(np.float64) * _UNIT * rate).astype(np.int64)
        keep = place < weight
        slot = (tb.mix(z[keep] ^ tb.U(_SLOT)) % tb.U(slots)).astype(np.int64)
        out.append((time[keep], slot, z[keep], owner[keep]))
        n += 1
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else None


def signatures(sh: np.ndarray, owner: np.ndarray, weight: np.ndarray, rows: int, slots: int) -> np.ndarray:
    """A ``rows x slots`` matrix of 64-bit entries; rows without shingles keep zeros."""
    sig = np.zeros((rows, slots), tb.U)
    parts = []
    block, todo = 0, np.arange(len(sh))
    while len(todo):
        low = 0 if block == 0 else 1 << (block - 1)
        todo = todo[weight[todo] > low]
        size = 1.0 if block == 0 else float(1 << (block - 1))
        parts.append((tb.mix(sh[todo] + tb.U(block * _SLOT & _MASK)), np.full(len(todo), size), np.full(len(todo), low, np.int64), weight[todo], owner[todo]))
        block += 1
    if not parts:
        return sig
    seed, rate, low, weight, owner = (np.concatenate(x) for x in zip(*parts, strict=True))
    inside = np.minimum(rate, weight - low)
    mass = np.bincount(owner, weights=inside, minlength=rows)
    goal = slots * (np.log(slots) + 3.0)
    horizon = np.where(mass > 0, goal / np.maximum(mass, 1.0), 0.0)
    while len(owner):
        found = _points(seed, rate, low, weight, owner, horizon, slots)
        best = np.full(rows * slots, np.inf)
        if found is not None:
            time, slot, z, who = found
            key = who * slots + slot
            np.minimum.at(best, key, time)
            hit = time == best[key]
            done = np.isfinite(best.reshape(rows, slots)).all(axis=1)
            hit &= done[who]
            sig.reshape(-1)[key[hit]] = z[hit]
        else:
            done = np.zeros(rows, bool)
        rest = ~done[owner]
        seed, rate, low, weight, owner = (x[rest] for x in (seed, rate, low, weight, owner))
        horizon = horizon * 2.0
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per row of ``sig`` and band; keys of different bands never meet on purpose."""
    place = tb.seeded(rows, 0xBA2D) | tb.U(1)
    parts = sig[:, : bands * rows].reshape(len(sig), bands, rows)
    return tb.mix((parts * place).sum(axis=2, dtype=tb.U) + tb.seeded(bands, 0xF00D))


def weighted_jaccard(left, right) -> np.ndarray:
    """sum(min)/sum(max) of the shingle bags of two text columns, row by row; 0 where either has none."""
    bags = []
    for column in (left, right):
        sh, owner, n = tb.row_bags(column)
        edge = np.searchsorted(owner, np.arange(len(column) + 1))
        bags.append((sh, n, edge))
    (sa, na, ea), (sb, nb, eb) = bags
    out = np.zeros(len(left))
    for k in range(len(left)):
        a, b = sa[ea[k] : ea[k + 1]], sb[eb[k] : eb[k + 1]]
        if not len(a) or not len(b):
            continue
        wa, wb = na[ea[k] : ea[k + 1]], nb[eb[k] : eb[k + 1]]
        at = np.minimum(np.searchsorted(b, a), len(b) - 1)
        both = b[at] == a
        common = np.minimum(wa[both], wb[at[both]]).sum()
        out[k] = common / (wa.sum() + wb.sum() - common)
    return out


@handing_back
def _keys(batches: Iterator[pa.RecordBatch], bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tb.pieces(batch):
            sh, owner, n = tb.row_bags(part.column("text"))
            sig = signatures(sh, owner, n, part.num_rows, bands * rows)
            keys = band_keys(sig, bands, rows).astype(np.int64)
            has = np.bincount(owner, minlength=part.num_rows) > 0
            lists = pa.ListArray.from_arrays(
                pa.array(np.r_[0, np.cumsum(np.where(has, bands, 0))].astype(np.int32)),
                pa.array(keys[has].reshape(-1)),
            )
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("digest"), lists], ["doc_id", "digest", "keys"])


@handing_back
def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in (x for y in tb.pieces(batch, "ta") for x in tb.pieces(y, "tb")):
            sim = weighted_jaccard(part.column("ta"), part.column("tb"))
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(sim)], ["a", "b", "sim"])


def similarities(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``(a, b, sim)`` for pairs of doc_ids, by exact multiset overlap of the two whole texts (one row per doc_id)."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb").mapInArrow(_compare, "a long, b long, sim double")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(doc_id, class_id, is_representative)``: class_id is the smallest doc_id of the class."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = docs.where("doc_id IS NOT NULL")
    light = known.select("doc_id", "text", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"))
    light = cut(
        light.mapInArrow(lambda it: _keys(it, bands, rows), "doc_id long, digest binary, keys array<long>"), "mh-keys"
    )
    first = light.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"))
    copies = (
        light.select("doc_id", "digest")
        .join(cut(first.where("n > 1"), "mh-first"), "digest")
        .where("doc_id <> rep")
        .select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    )
    copies = cut(copies, "mh-copies")
    banded = light.join(copies.select(F.col("b").alias("doc_id")).distinct(), "doc_id", "left_anti").select(
        F.col("doc_id").alias("id"), F.explode("keys").alias("key")
    )
    sizes = cut(banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "mh-sizes")
    shared = cut(banded.join(sizes, "key"), "mh-shared")
    # A text that many others were made from shares more buckets with them than they share among themselves.
    weight = shared.groupBy("id").agg(F.sum("n").alias("w"))
    ranked = shared.join(weight, "id").select("key", "id", F.struct("w", (-F.col("id")).alias("i")).alias("r"))
    leaders = cut(ranked.groupBy("key").agg((-F.max("r").getField("i")).alias("a")), "mh-leaders")
    members = cut(shared.select("key", "id").join(leaders, "key"), "mh-members")
    # All later steps read the texts of documents in shared buckets alone; one plan at every size.
    ids = shared.select(F.col("id").alias("doc_id")).distinct().hint("merge")
    texts = cut(known.join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text")).withColumn("bytes", F.octet_length("text")), "mh-texts")
    stars = members.where("id <> a").select("a", F.col("id").alias("b")).distinct()
    scored = cut(similarities(stars, texts), "mh-scored")
    links = scored.where(F.col("sim") >= similarity).select("a", "b")
    links = cut(links.union(_rest(members, links, texts, similarity)).union(copies), "mh-links")
    comp = connected_components(links, "a", "b")
    ids = known.select("doc_id").distinct()
    out = ids.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", F.coalesce("component", "doc_id").alias("class_id")
    )
    out = out.union(docs.where("doc_id IS NULL").select("doc_id", F.lit(None).cast("long").alias("class_id")))
    return out.withColumn("is_representative", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def _cross(t: pa.Table, similarity: float) -> pa.Table:
    """Links between a block of a group and one of its documents outside the largest component, one per document and component of the latter."""
    out: list[tuple[int, int]] = []
    side = np.asarray(t.column("side"), np.int64)
    own = t.filter(pa.array(side == 0))
    other = t.filter(pa.array(side == 1))
    (ia, ca, sa, na, ea), (ib, cb, sb, nb, eb) = (_bags(x) for x in (own, other))
    if len(np.unique(np.r_[ca, cb])) > 1 and len(sa) and len(sb):
        wa, wb = np.add.reduceat(np.r_[na, 0], ea[:-1]) * (np.diff(ea) > 0), np.add.reduceat(np.r_[nb, 0], eb[:-1]) * (np.diff(eb) > 0)
        owner = np.repeat(np.arange(len(ib)), np.diff(eb))
        order = np.argsort(sb, kind="stable")
        sb, nb, owner = sb[order], nb[order], owner[order]
        for k in range(len(ia)):
            s, n = sa[ea[k] : ea[k + 1]], na[ea[k] : ea[k + 1]]
            lo, hi = np.searchsorted(sb, s), np.searchsorted(sb, s, "right")
            size = hi - lo
            at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
            common = np.bincount(owner[at], weights=np.minimum(nb[at], np.repeat(n, size)), minlength=len(ib))
            near = np.flatnonzero((common > 0) & (cb != ca[k]) & (common >= similarity * (wa[k] + wb - common)))
            if len(near):
                _, first = np.unique(cb[near], return_index=True)
                out += [(int(ia[k]), int(ib[j])) for j in near[first]]
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([x for _, x in out], pa.int64())})


def _bags(t: pa.Table) -> tuple[np.ndarray, ...]:
    sh, n, size = [np.zeros(0, tb.U)], [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]
    for part in (x for batch in t.to_batches() for x in tb.pieces(batch)):
        hashes, owner, count = tb.row_bags(part.column("text"))
        sh.append(hashes)
        n.append(count)
        size.append(np.bincount(owner, minlength=part.num_rows))
    ids, comp = (np.asarray(t.column(c), np.int64) for c in ("id", "c"))
    return ids, comp, np.concatenate(sh), np.concatenate(n), np.cumsum(np.concatenate(size))


def _rest(members: DataFrame, links: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links that the comparisons with leading members missed; a pair of blocks is one task's work and gives links alone."""
    return _blocks(members, links, texts).groupBy("g", "i", "j").applyInArrow(lambda t: _cross(t, similarity), "a long, b long")


def _blocks(members: DataFrame, links: DataFrame, texts: DataFrame) -> DataFrame:
    """``(g, i, j, side, id, c, text)``: what is compared in groups with several components.

    Documents that buckets connect form a group. Blocks of about `BLOCK` documents or `BLOCK_BYTES` outside the largest
    component (side 1) stand against blocks of about `WIDE` documents or `WIDE_BYTES` of the whole group (side 0).
    """
    comp = connected_components(links, "a", "b").withColumnRenamed("node", "id").withColumnRenamed("component", "c")
    group = connected_components(members.where("id <> a"), "a", "id").withColumnRenamed("node", "id").withColumnRenamed("component", "g")
    named = group.join(comp, "id", "left").join(texts.select(F.col("doc_id").alias("id"), "bytes"), "id")
    named = cut(named.select("id", "g", F.coalesce("c", "id").alias("c"), "bytes"), "mh-named")
    sizes = named.groupBy("g", "c").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    whole = sizes.groupBy("g").agg(F.max(F.struct("n", "c", "bytes")).alias("most"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).where("n > most.n")
    parts = lambda n, rows, size, most: F.greatest(F.ceil(n / rows), F.ceil(size / most)).cast("int")
    cols = parts(F.col("n") - F.col("most.n"), BLOCK, F.col("bytes") - F.col("most.bytes"), BLOCK_BYTES)
    blocks = whole.select("g", F.col("most.c").alias("big"), parts(F.col("n"), WIDE, F.col("bytes"), WIDE_BYTES).alias("rows"), cols.alias("cols"))
    todo = cut(named.drop("bytes").join(cut(blocks, "mh-mixed"), "g"), "mh-todo")
    placed = texts.select(F.col("doc_id").alias("id"), "text").join(todo, "id")
    part = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    first = placed.select("g", part(F.col("rows")).alias("i"), F.explode(F.sequence(F.lit(0), F.col("cols") - 1)).alias("j"), F.lit(0).alias("side"), "id", "c", "text")
    second = placed.where("c <> big").select("g", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"), part(F.col("cols")).alias("j"), F.lit(1).alias("side"), "id", "c", "text")
    return first.union(second)
