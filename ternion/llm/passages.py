"""Exact removal of repeated passages by suffix order, over shards that together hold every repeat.

A byte goes if a string of ``length`` bytes that covers it also starts in a document with a smaller doc_id.
Strings are judged on the input. Every such string has one anchor, its rarest-hashing 24-byte part, so two
equal strings have equal anchors; consecutive strings with one anchor are a run, and a run's bytes are its
context.

1. Anchors are counted as 64-bit words per bucket: which occur twice, and in which blocks of documents.
2. Blocks send the distinct contexts of repeated anchors, each with its smallest doc_id, to the anchor's shard.
3. A shard orders the suffixes of its contexts by external induced sorting with common prefixes
   (`ternion.llm.induced`); neighbours that share ``length`` bytes are one string, whose smallest doc_id goes
   back to the blocks that sent its contexts.
4. Blocks mark the strings that have a smaller doc_id elsewhere and cut the covered bytes.

Equal texts are joined by digest beforehand: every copy but the one with the smallest doc_id is covered whole
if it has ``length`` bytes. Blocks, buckets and shards grow in number with the bytes of the texts. A frequent passage comes to its shard once per block and not once per document;
what a shard holds follows the distinct repeated text, and its queues spill.

Nulls and edge cases: a null text is empty; a null doc_id counts as larger than all others; rows with equal
doc_id do not take from one another; texts shorter than ``length`` keep all bytes; other columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ternion.llm import textbytes as tb
from ternion.llm.induced import suffix_order
from ternion.llm.tables import small_batches
from ternion.plans.lineage import cut

LENGTH, PART, BLOCK_BYTES = 50, 24, 8 << 20
SHARD_BYTES = 16 << 20
_LAST = 2**63 - 1


def runs(data: np.ndarray, off: np.ndarray, length: int = LENGTH, part: int = PART) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings with one anchor: anchor hash, first and last string start, row."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none.astype(tb.U), none, none, none
    h = tb.window_hashes(data, part)
    width, step = length - part + 1, 1
    if n <= 1 << 24:  # hash and position in one word: the smallest is the left-most of the smallest hashes
        best = h & ~tb.U((1 << 24) - 1) | np.arange(len(h), dtype=tb.U)
        while step * 2 <= width:
            best = np.minimum(best[:-step], best[step:])
            step *= 2
        if step < width:
            best = np.minimum(best[: step - width], best[width - step :])
        index = (best & tb.U((1 << 24) - 1)).astype(np.int64)
    else:
        best, index = h >> tb.U(24), np.arange(len(h))
        while step * 2 <= width:
            best, index = _least(best, index, step)
            step *= 2
        if step < width:
            best, index = _least(best, index, width - step)
    room = np.maximum(np.diff(off) - length + 1, 0)
    row = np.repeat(np.arange(len(room)), room)
    q = np.arange(len(row)) + np.repeat(off[:-1] - (np.cumsum(room) - room), room)
    if not len(q):
        return none.astype(tb.U), none, none, none
    anchor = index[q]
    new = np.ones(len(q), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(q)] - 1
    return h[anchor[first]], q[first], q[last], row[first]


def _least(best: np.ndarray, index: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """The smaller of each entry and the one ``shift`` on; the left one on ties."""
    right = best[shift:] < best[: len(best) - shift]
    return np.where(right, best[shift:], best[: len(best) - shift]), np.where(right, index[shift:], index[: len(index) - shift])


def _anchors(docs: pa.Table, marks: pa.Table, buckets: int) -> pa.Table:
    """The anchors of a block of documents by bucket, each twice at most."""
    held = [np.zeros(0, tb.U)]
    for part, data, off, _ in _block(docs, marks):
        h, _, _, _ = runs(data, off)
        held.append(h)
    words = np.sort(np.concatenate(held))
    words = words[np.r_[np.ones(min(2, len(words)), bool), words[2:] != words[:-2]]]
    parts = np.split(words, np.searchsorted(words, (np.arange(1, buckets) * ((1 << 64) // buckets)).astype(tb.U)))
    some = [k for k, p in enumerate(parts) if len(p)]
    block = [docs.column("block")[0].as_py()] * len(some) if some else []
    return pa.table({"bucket": pa.array(some, pa.int32()), "block": pa.array(block, pa.int32()), "words": pa.array([parts[k].tobytes() for k in some], pa.binary())})


def _repeated(t: pa.Table) -> pa.Table:
    """The anchors of a bucket that occur twice, by block."""
    words = [np.frombuffer(x, tb.U) for x in t.column("words").to_pylist()]
    h, block = np.concatenate(words), np.repeat(np.asarray(t.column("block").combine_chunks(), np.int64), [len(x) for x in words])
    del words
    order = np.argsort(h, kind="stable")
    h, block = h[order], block[order]
    twice = np.zeros(len(h), bool)
    twice[1:] = h[1:] == h[:-1]
    twice[:-1] |= twice[1:]
    h, block = h[twice], block[twice]
    order = np.lexsort((h, block))
    h, block = h[order], block[order]
    fresh = np.r_[True, (h[1:] != h[:-1]) | (block[1:] != block[:-1])] if len(h) else np.zeros(0, bool)
    h, block = h[fresh], block[fresh]
    kinds, at = np.unique(block, return_index=True)
    return pa.table({"block": pa.array(kinds.astype(np.int32)), "anchors": pa.array([x.tobytes() for x in (np.split(h, at[1:]) if len(kinds) else [])], pa.binary())})


def _block(t: pa.Table, marks: pa.Table, copies: bool = False) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of a block of documents with their bytes and doc_ids; a null doc_id is the largest.

    Marked copies of whole texts are left out, or are the only ones given.
    """
    gone = {(i, d) for i, d in zip(marks.column("id").to_pylist(), marks.column("digest").to_pylist(), strict=True) if d is not None}
    ids = {i for i, _ in gone}
    for batch in t.combine_chunks().to_batches():
        for part in tb.pieces(batch):
            own = np.asarray(part.column("doc_id").fill_null(_LAST), np.int64)
            if gone:
                text = part.column("text")
                marked = [i in ids and (i, hashlib.md5(text[k].as_py().encode()).digest()) in gone for k, i in enumerate(own.tolist())]
                take = np.flatnonzero(np.array(marked) == copies)
                part, own = part.take(pa.array(take)), own[take]
            elif copies:
                return
            if part.num_rows:
                yield part, *tb.flat(part.column("text")), own


def _contexts(docs: pa.Table, found: pa.Table, shards: int) -> pa.Table:
    """The distinct contexts of repeated anchors in a block, by shard."""
    empty = {"shard": pa.array([], pa.int32()), "block": pa.array([], pa.int32()), "sizes": pa.array([], pa.binary()), "low": pa.array([], pa.binary()), "high": pa.array([], pa.binary()), "bytes": pa.array([], pa.binary())}
    if not docs.num_rows or not found.num_rows:
        return pa.table(empty)
    known = np.sort(np.concatenate([np.zeros(0, tb.U), *(np.frombuffer(x, tb.U) for x in found.column("anchors").to_pylist() if x)]))
    if not len(known):
        return pa.table(empty)
    names, lows, highs, shard, texts, sizes = [], [], [], [], [], []
    seen: np.ndarray = np.zeros(0, tb.U)
    for _, data, off, ids in _block(docs, found):
        h, a, z, row = runs(data, off)
        at = np.minimum(np.searchsorted(known, h), len(known) - 1)
        hit = known[at] == h
        h, a, z, row = h[hit], a[hit], z[hit] + LENGTH, row[hit]
        name = tb.span_hashes(data, a, z)
        names.append(name)
        lows.append(ids[row])
        u, one = np.unique(name, return_index=True)
        fresh = ~np.isin(u, seen)
        u, one = u[fresh], one[fresh]
        seen = np.r_[seen, u]
        highs.append(u)
        shard.append((h[one] % tb.U(shards)).astype(np.int64))
        sizes.append(z[one] - a[one])
        texts.append(_gather(data, a[one], z[one]))
    name, doc = np.concatenate(names), np.concatenate(lows)
    order = np.lexsort((doc, name))
    name, doc = name[order], doc[order]
    if not len(name):
        return pa.table(empty)
    first = np.flatnonzero(np.r_[True, name[1:] != name[:-1]])
    low, high, kinds = doc[first], doc[np.r_[first[1:], len(doc)] - 1], name[first]
    own, shard_of, size = np.concatenate(highs), np.concatenate(shard), np.concatenate(sizes)
    raw = np.concatenate(texts)
    start = np.cumsum(size) - size
    to = np.argsort(shard_of, kind="stable")
    at = np.searchsorted(kinds, own[to])
    groups, edge = np.unique(shard_of[to], return_index=True)
    out = {k: [] for k in empty}
    for g, rows in zip(groups.tolist(), np.split(np.arange(len(to)), edge[1:]), strict=True):
        mine = to[rows]
        out["shard"].append(g)
        out["block"].append(docs.column("block")[0].as_py())
        out["sizes"].append(size[mine].astype(np.uint8).tobytes())
        out["low"].append(low[at[rows]].tobytes())
        out["high"].append(high[at[rows]].tobytes())
        out["bytes"].append(_gather(raw, start[mine], start[mine] + size[mine]).tobytes())
    return pa.table({k: pa.array(v, empty[k].type) for k, v in out.items()})


def _gather(data: np.ndarray, a: np.ndarray, z: np.ndarray) -> np.ndarray:
    """The bytes of spans, end to end."""
    size = z - a
    return data[np.repeat(a - (np.cumsum(size) - size), size) + np.arange(size.sum())]


def _shard(t: pa.Table) -> pa.Table:
    """For the contexts of a shard: the smallest doc_id of each of their strings, where it matters to the block."""
    block, sizes, low, high, raw = (t.column(c).to_pylist() for c in ("block", "sizes", "low", "high", "bytes"))
    counts = [len(x) for x in sizes]
    size = np.concatenate([np.frombuffer(x, np.uint8) for x in sizes]).astype(np.int64)
    low, high = (np.concatenate([np.frombuffer(x, np.int64) for x in v]) for v in (low, high))
    owner = np.repeat(np.arange(len(block)), counts)
    data = np.frombuffer(b"".join(raw), np.uint8)
    start = np.cumsum(size) - size
    name = tb.span_hashes(data, start, start + size)
    kinds, one, inv = np.unique(name, return_index=True, return_inverse=True)
    least = np.full(len(kinds), _LAST)
    np.minimum.at(least, inv, low)
    text = _gather(data, start[one], start[one] + size[one])
    own_size = size[one]
    base = np.cumsum(own_size) - own_size
    context = np.repeat(np.arange(len(kinds)), own_size)
    inside = np.arange(len(text)) - base[context]
    judged = inside <= own_size[context] - LENGTH
    pos, lcp = suffix_order(text, LENGTH)
    split = np.ones(len(pos), bool)
    split[1:] = lcp[1:] < LENGTH
    string = np.cumsum(split) - 1
    take = judged[pos]
    smallest = np.full(int(string[-1]) + 1 if len(string) else 0, _LAST)
    np.minimum.at(smallest, string[take], least[context[pos[take]]])
    value = np.full(len(text), _LAST)
    value[pos] = smallest[string]
    value[~judged] = _LAST
    lowest = np.minimum.reduceat(value, base) if len(base) else value
    useful = lowest[inv] < high
    out: dict[str, list] = {"block": [], "names": [], "counts": [], "values": []}
    strings = own_size - LENGTH + 1
    for b in np.unique(owner[useful]).tolist():
        mine = inv[(owner == b) & useful]
        out["block"].append(block[b])
        out["names"].append(kinds[mine].tobytes())
        out["counts"].append(strings[mine].astype(np.uint8).tobytes())
        out["values"].append(_gather(value, base[mine], base[mine] + strings[mine]).tobytes())
    return pa.table({"block": pa.array(out["block"], pa.int32())} | {k: pa.array(out[k], pa.binary()) for k in ("names", "counts", "values")})


def _cut(docs: pa.Table, found: pa.Table) -> pa.Table:
    """The documents of a block with the covered bytes taken out."""
    out: dict[str, list] = {k: [] for k in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
    names = np.concatenate([np.zeros(0, tb.U), *(np.frombuffer(x, tb.U) for x in found.column("names").to_pylist() if x)])
    counts = np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(x, np.uint8) for x in found.column("counts").to_pylist() if x)]).astype(np.int64)
    values = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x, np.int64) for x in found.column("values").to_pylist() if x)])
    begin = np.cumsum(counts) - counts
    order = np.argsort(names)
    names, begin, counts = names[order], begin[order], counts[order]
    for part, data, off, ids in _block(docs, found):
        gone = np.zeros(len(data) + 1, np.int64)
        if len(names):
            _, a, z, row = runs(data, off)
            name = tb.span_hashes(data, a, z + LENGTH)
            at = np.minimum(np.searchsorted(names, name), len(names) - 1)
            hit = names[at] == name
            a, row, at = a[hit], row[hit], at[hit]
            n = counts[at]
            start = np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            value = _gather(values, begin[at], begin[at] + n)
            start = start[value < ids[np.repeat(row, n)]]
            np.add.at(gone, start, 1)
            np.add.at(gone, start + LENGTH, -1)
        lost = np.cumsum(gone)[:-1] > 0
        edge = lost.copy()
        edge[1:] &= ~lost[:-1]
        heads = off[:-1][np.diff(off) > 0]
        edge[heads] = lost[heads]
        total, spans = np.r_[0, np.cumsum(lost)], np.r_[0, np.cumsum(edge)]
        for k in range(part.num_rows):
            x, y = int(off[k]), int(off[k + 1])
            kept = data[x:y][~lost[x:y]].tobytes()
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["kept"].append(kept)
        out["doc_id"] += part.column("doc_id").to_pylist()
        out["n_bytes"] += np.diff(off).tolist()
        out["n_removed"] += (total[off[1:]] - total[off[:-1]]).tolist()
        out["n_spans"] += (spans[off[1:]] - spans[off[:-1]]).tolist()
    for part, _, off, _ in _block(docs, found, copies=True):
        n = part.num_rows
        out["doc_id"] += part.column("doc_id").to_pylist()
        out["n_bytes"] += np.diff(off).tolist()
        out["n_removed"] += np.diff(off).tolist()
        out["n_spans"] += [1] * n
        out["kept_sha256"] += [hashlib.sha256(b"").hexdigest()] * n
        out["kept"] += [b""] * n
    return pa.table({"doc_id": pa.array(out["doc_id"], pa.int64())} | {k: pa.array(out[k], pa.int64()) for k in ("n_bytes", "n_removed", "n_spans")} | {"kept_sha256": pa.array(out["kept_sha256"], pa.string()), "kept": pa.array(out["kept"], pa.binary())})


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept)`` of every row; ``kept`` are the remaining bytes."""
    spark = docs.sparkSession
    small_batches(spark)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keyed = rows.select(F.coalesce("doc_id", F.lit(_LAST)).alias("id"), F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), F.octet_length("text").cast("long").alias("n"))
    keyed = cut(keyed, "sa-keys")
    first = keyed.groupBy("digest").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("c"))
    copies = cut(keyed.join(first.where("c > 1"), "digest").where("id > rep").select("id", "digest", "n"), "sa-copies")
    total = keyed.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("b")).first()["b"]
    blocks, shards = max(parts, -(-total // BLOCK_BYTES)), max(4 * parts, -(-total // SHARD_BYTES))
    buckets = max(parts, blocks // 8)
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int").alias("block")
    # The three uses of the texts by block share one exchange.
    texts = rows.select("doc_id", "text", block(F.coalesce("doc_id", F.lit(_LAST)))).groupBy("block")
    marks = copies.where(F.col("n") >= LENGTH).select(block("id"), "id", "digest").distinct()
    marks = marks.select("block", "id", "digest", F.lit(None).cast("binary").alias("anchors"))
    found = (
        texts.cogroup(marks.groupBy("block"))
        .applyInArrow(lambda a, b: _anchors(a, b, buckets), "bucket int, block int, words binary")
        .groupBy("bucket")
        .applyInArrow(_repeated, "block int, anchors binary")
    )
    found = found.select("block", F.lit(None).cast("long").alias("id"), F.lit(None).cast("binary").alias("digest"), "anchors")
    contexts = texts.cogroup(found.union(marks).groupBy("block")).applyInArrow(
        lambda a, b: _contexts(a, b, shards), "shard int, block int, sizes binary, low binary, high binary, bytes binary"
    )
    judged = contexts.groupBy("shard").applyInArrow(_shard, "block int, names binary, counts binary, values binary")
    judged = judged.select("block", F.lit(None).cast("long").alias("id"), F.lit(None).cast("binary").alias("digest"), "names", "counts", "values")
    none = F.lit(None).cast("binary")
    marked = marks.select("block", "id", "digest", none.alias("names"), none.alias("counts"), none.alias("values"))
    return texts.cogroup(judged.union(marked).groupBy("block")).applyInArrow(_cut, _RESULT)
