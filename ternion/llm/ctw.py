"""Language-model scores by context-tree weighting over bytes.

A text is its UTF-8 bytes with A-Z folded, closed by one zero byte. Each byte is eight binary decisions along
a tree of its bit prefixes; each decision has a Krichevsky-Trofimov estimate in every context of 0 to
``depth`` preceding bytes, and the context tree mixes the estimates of all depths by their block
probabilities over the training texts. As a block probability depends on a node's counts alone, the model
follows from the counts of (depth+1)-grams. With the counts fixed, the probability of a byte is a function of its
gram, so scoring is one table look-up a byte, and a text's code length per byte follows from the sum.

1. Every partition counts its grams and sends them, sorted and packed, to the tree bucket of their ``TOP`` nearest
   bytes. A bucket adds them up and evaluates the nodes of depth ``TOP`` and more; what it writes is one row.
2. The sums over the nodes of depth ``TOP`` by shorter context go to the driver (at most 256 ** (TOP - 1) contexts),
   which evaluates the nodes above and broadcasts, by context and bit prefix, what they make of a deeper estimate.
3. Each tree bucket turns its grams into log-probabilities and deals them to look-up buckets by ``NEAR`` bytes of context.
4. Texts are cut into chunks; a chunk sends its distinct grams and words to their look-up buckets and gets their values
   back; there it sums them up over its texts, which travel with it, compressed. The word-unigram base takes the
   same way: a look-up bucket adds up the training counts of its words.

The gram table is never in one place, and grams that only held-out texts have take part with count zero: their
estimates come from the shallower contexts, and they change no other.

Bounds: the depth is the same at every size and all counts are complete. Buckets grow in number with the bytes of
the texts. One task holds the distinct grams of at least one run of TOP nearest bytes, or what all chunks ask of one run of NEAR.
A counting task sends its grams beyond GRAMS distinct ones and starts anew; trees are evaluated FOREST grams at a time, or one run of TOP.
Log-probabilities of bytes travel with 16 bits of mantissa.

Nulls and edge cases: null and empty texts are the end symbol alone; a null doc_id is a training row; a zero
byte inside a text is an ordinary symbol; repeated rows are each counted and scored; other columns are
ignored; without training rows every estimate is one half; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ternion.llm import textbytes as tb
from ternion.llm.tables import hand_back, small_batches
from ternion.plans.lineage import cut

DEPTH, TOP, NEAR, CHUNK_BYTES, BUCKET_BYTES = 7, 3, 4, 8 << 20, 8 << 20
#: Distinct grams that a task counts before it sends them; grams, repeated ones too, that wait to be added to these; distinct ones of trees that are evaluated together.
GRAMS, WAITING, FOREST = 6_000_000, 2_000_000, 100_000
#: Bytes of the texts, and grams, that one step works on, so that caches hold them; grams that are sorted together.
PIECE_BYTES, FEW, SORTED = 1 << 18, 1 << 16, 4_000_000
_HALF, _LOW_HALF = math.log(0.5), np.uint64(0xFFFFFFFF)
_TEXT, _QUICK = pa.Codec("zstd", compression_level=5), pa.Codec("zstd", compression_level=1)


def held_out() -> Column:
    """Rows that the model never learns from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))


def grams(data: np.ndarray, off: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The gram of every byte and end symbol, text by text, and the texts' offsets in it.

    A gram's lowest byte is the symbol, its highest the nearest byte before it: ascending grams stand in the order
    of the context tree.
    """
    n = len(off) - 1
    gap = depth + 1  # a text's start is preceded by zeros: its predecessor's end and `depth` more
    size = np.diff(off)
    place = np.arange(len(data)) + np.repeat(np.arange(n) * gap + 7, size)
    wide = np.zeros(len(data) + n * gap + 7, np.uint8)
    wide[place] = data
    # Each place's eight last bytes as one word, the newest highest: `depth` + 1 of them, turned by one.
    key = np.ndarray((len(wide) - 7,), "<u8", wide, strides=(1,))
    key = key[np.arange(len(data) + n) + np.repeat(np.arange(n) * (gap - 1), size + 1)] >> tb.U(8 * (7 - depth))
    key = (key << tb.U(8) | key >> tb.U(8 * depth)) & tb.U((1 << 8 * (depth + 1)) - 1)
    return key, off + np.arange(n + 1)


def context(g: np.ndarray, depth: int, near: int) -> np.ndarray:
    """The ``near`` nearest bytes of grams."""
    return g >> tb.U(8 * (depth - min(near, depth) + 1))


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    at = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, np.int64)
    return k[at], np.add.reduceat(c, at) if len(k) else c


def _unique(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = np.sort(x) if len(x) < 2 or (x[1:] < x[:-1]).any() else x
    at = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, np.int64)
    return x[at], np.diff(np.r_[at, len(x)])


def squeeze(x: np.ndarray, ascending: bool = False) -> bytes:
    """An array as bytes: the differences of ascending words, laid out plane by plane and compressed. Counts (int64, not negative) take as few planes as the largest needs."""
    if ascending and len(x):
        x = np.r_[x[:1], x[1:] - x[:-1]]
    if x.dtype == np.int64 and len(x):
        x = x.astype(np.min_scalar_type(x.max()))
    raw = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes() if len(x) else b""
    return len(x).to_bytes(7, "little") + bytes([x.itemsize % 8]) + (_QUICK.compress(raw, asbytes=True) if raw else b"")


def expand(raw: bytes, kind: type, ascending: bool = False) -> np.ndarray:
    """What `squeeze` was given."""
    n, width = int.from_bytes(raw[:7], "little"), raw[7] or 8
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(_QUICK.decompress(raw[8:], n * width, asbytes=True), np.uint8).reshape(width, n)
    x = np.ascontiguousarray(planes.T).view(f"<u{width}" if kind is np.int64 else kind).reshape(n).astype(kind, copy=False)
    return np.cumsum(x, dtype=kind) if ascending else x


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each word."""
    return (tb.mix(keys) >> tb.U(40)).astype(np.int64) % buckets


def _dealt(x: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with rows, and these in their order. Equal words of ``x`` stand together: runs are dealt, not rows."""
    first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, np.int64)
    to, size = bucket_of(x[first], buckets), np.diff(np.r_[first, len(x)])
    order, edge = np.argsort(to, kind="stable"), np.r_[0, np.cumsum(np.bincount(to, minlength=buckets))]
    for b in np.flatnonzero(np.diff(edge)).tolist():
        run = order[edge[b] : edge[b + 1]]
        n = size[run]
        yield b, np.repeat(first[run] - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _known(k: np.ndarray, c: np.ndarray, learned: list[np.ndarray], held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Adds the grams that wait in the lists, and leaves these empty, to the counts of ascending words; places, words and counts of those that are not among them. Held ones count nothing."""
    new, n = _drained(learned)
    other = _drained(held)[0]
    at = np.searchsorted(new, other)
    fresh = ~_found(new, at, other)
    new, n = np.insert(new, at[fresh], other[fresh]), np.insert(n, at[fresh], 0)
    at = np.searchsorted(k, new)
    found = _found(k, at, new)
    c[at[found]] += n[found]
    found = ~found
    at = at[found]  # one after the other, as long arrays wait twice meanwhile
    new = new[found]
    return at, new, n[found]


def _drained(waiting: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of arrays, which their list gives up, and how often each occurs."""
    x = np.concatenate([np.zeros(0, tb.U), *waiting])
    waiting.clear()
    x.sort()
    return _unique(x)


def _found(k: np.ndarray, at: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whether ascending words ``k`` hold each of ``x`` at its place."""
    found = at < len(k)
    found[found] = k[at[found]] == x[found]
    return found


_COUNTED = "bucket int, grams binary, counts binary"


def _count(batches: Iterator[pa.RecordBatch], depth: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """The grams of a partition with their training counts, by tree bucket."""
    k, c, learned, unseen, waiting = np.zeros(0, tb.U), np.zeros(0, np.int64), [], [], 0

    def emit() -> Iterator[pa.RecordBatch]:
        for b, at in _dealt(context(k, depth, TOP), buckets):
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([squeeze(k[at], True)], pa.binary()), pa.array([squeeze(c[at])], pa.binary())], ["bucket", "grams", "counts"])

    for batch in batches:
        for part in tb.pieces(batch, limit=PIECE_BYTES):
            data, off = tb.flat(part.column("text"))
            key, edge = grams(tb.FOLD[data], off, depth)
            held = np.repeat(np.asarray(part.column("held_out").to_numpy(zero_copy_only=False), bool), np.diff(edge))
            learned.append(key[~held])
            unseen.append(key[held])
            waiting += len(key)
            del key
            if waiting > WAITING:
                at, fresh, n = _known(k, c, learned, unseen)
                k = np.insert(k, at, fresh)  # one after the other: neither array is held twice while the other is
                c = np.insert(c, at, n)
                waiting = 0
                if len(k) > GRAMS:
                    yield from emit()
                    k, c = k[:0].copy(), c[:0].copy()
                hand_back()
    if waiting:
        at, fresh, n = _known(k, c, learned, unseen)
        k = np.insert(k, at, fresh)
        c = np.insert(c, at, n)
    yield from emit()
    del k, c
    hand_back()


_LANCZOS_SHIFT = 8


def _lgamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for positive x: Stirling's series behind a shift."""
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(_LANCZOS_SHIFT):
        low = y < _LANCZOS_SHIFT
        shift[low] += np.log(y[low])
        y[low] += 1.0
    r = 1.0 / (y * y)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


_SMALL = 64
_LOW = _lgamma(np.arange(2 * _SMALL) * 0.5 + 0.5)


def _block(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a block with these counts."""
    total = zeros + ones
    out = np.zeros(len(total))
    some = np.flatnonzero(total)
    low = some[total[some] < _SMALL - 1]
    a, t = ones[low].astype(np.int64), total[low].astype(np.int64)
    out[low] = _LOW[2 * a] + _LOW[2 * (t - a)] - _LOW[2 * t + 1] - math.log(math.pi)
    big = some[total[some] >= _SMALL - 1]
    out[big] = _lgamma(zeros[big] + 0.5) + _lgamma(ones[big] + 0.5) - _lgamma(total[big] + 1.0) - math.log(math.pi)
    return out


class Tree:
    """The nodes of depths ``top`` to ``depth`` over ascending grams with their counts.

    ``below`` may hold, for each decision, the sums of ln P_w over children deeper than ``depth``.
    """

    def __init__(self, g: np.ndarray, n: np.ndarray, depth: int, top: int, below: list[np.ndarray] | None = None):
        self.depth, self.top, self.rows = depth, top, [None] * (depth + 1)
        self.kt, self.weight, self.pw = ([[None] * 8 for _ in range(depth + 1)] for _ in range(3))
        self.first = [[None] * 8 for _ in range(depth + 1)]
        key, count, up = g, n.astype(np.float64), np.arange(len(g))
        self.keys = [None] * (depth + 1)
        for d in range(depth, top - 1, -1):
            if d < depth:
                merged, inv = np.unique((key >> tb.U(16)) << tb.U(8) | key & tb.U(255), return_inverse=True)
                up, count, key = inv, np.bincount(inv, weights=count, minlength=len(merged)), merged
                self.rows[d] = inv[self.rows[d + 1]]
            else:
                self.rows[d] = np.arange(len(g))
            self.keys[d] = key
            for level in range(8):
                prefix = key >> tb.U(8 - level)
                new = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]]) if len(prefix) else np.zeros(0, np.int64)
                node = np.repeat(np.arange(len(new)), np.diff(np.r_[new, len(prefix)]))
                bit = ((key >> tb.U(7 - level)) & tb.U(1)).astype(bool)
                total, ones = (np.add.reduceat(x, new) if len(new) else np.zeros(0) for x in (count, count * bit))
                pe = _block(total - ones, ones)
                if d < depth:
                    kids = self.first[d + 1][level]
                    sums = np.bincount(node[up[kids]], weights=self.pw[d + 1][level], minlength=len(new))
                else:
                    sums = below[level] if below is not None else None
                self.first[d][level] = new
                self.pw[d][level] = pe if sums is None else np.logaddexp(_HALF + pe, _HALF + sums)
                self.weight[d][level] = None if sums is None else np.exp(_HALF + pe - self.pw[d][level])[node]
                self.kt[d][level] = (np.where(bit, ones[node], (total - ones)[node]) + 0.5) / (total[node] + 1.0)

    def estimate(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """What the nodes make of a deeper estimate p of a gram's decision: (a, b) for a + b * p; b is 0 where none is deeper."""
        rows = len(self.rows[self.depth])
        a, b = np.zeros(rows), np.ones(rows)
        for d in range(self.depth, self.top - 1, -1):
            at, w = self.rows[d], self.weight[d][level]
            if w is None:
                a, b = self.kt[d][level][at], np.zeros(rows)
            else:
                w = w[at]
                a, b = w * self.kt[d][level][at] + (1.0 - w) * a, (1.0 - w) * b
        return a, b


_TREE = "bucket int, grams binary, counts binary, node binary, value binary"


def _tree(t: pa.Table, depth: int, top: int) -> pa.Table:
    """The summed grams of a tree bucket and, by the context above its nodes, their symbols' counts and sums of ln P_w.

    A node stands as (context of top - 1 bytes) << 9 | bit prefix; prefixes of all eight bits carry counts.
    """
    parts = t.select(["grams", "counts"]).to_pylist()
    g, n = _merge([np.zeros(0, tb.U), *(expand(r["grams"], tb.U, True) for r in parts)], [np.zeros(0, np.int64), *(expand(r["counts"], np.int64) for r in parts)])
    nodes, values = [np.zeros(0, tb.U)], [np.zeros(0)]
    for a, z in _forest(g, depth, top):
        own, tree = g[a:z], Tree(g[a:z], n[a:z], depth, top)
        keys = [tree.keys[top][first] for first in tree.first[top]]
        node = [_parent(key, top) << tb.U(9) | tb.U(1 << level) | (key & tb.U(255)) >> tb.U(8 - level) for level, key in enumerate(keys)]
        leaf = _parent(own >> tb.U(8 * (depth - top + 1)) << tb.U(8), top) << tb.U(9) | tb.U(256) | own & tb.U(255)
        node, value = _merge([*node, leaf], [*tree.pw[top], n[a:z].astype(np.float64)])
        nodes.append(node)
        values.append(value)
    node, value = _merge(nodes, values)
    out = pa.table({"bucket": pa.array([t.column("bucket")[0].as_py()], pa.int32())} | {k: pa.array([v], pa.binary()) for k, v in (("grams", squeeze(g, True)), ("counts", squeeze(n)), ("node", squeeze(node, True)), ("value", squeeze(value)))})
    del g, n, nodes, values, parts
    hand_back()
    return out


def _forest(g: np.ndarray, depth: int, top: int) -> Iterator[tuple[int, int]]:
    """Ranges of ascending grams, of about FOREST each, that part no run of ``top`` nearest bytes: such runs share no node of depth ``top`` or more."""
    x = context(g, depth, top)
    starts, a = np.r_[np.flatnonzero(np.r_[True, x[1:] != x[:-1]]), len(x)], 0
    while a < len(x):
        z = int(starts[max(np.searchsorted(starts, a, "right"), np.searchsorted(starts, a + FOREST, "right") - 1)])
        yield a, z
        a = z


def _parent(key: np.ndarray, depth: int) -> np.ndarray:
    """The context of ``depth - 1`` bytes of grams of ``depth``."""
    return key >> tb.U(16) if depth else key >> tb.U(8)


def _above(nodes: np.ndarray, values: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From the sums of `_tree` over all buckets: by node of depth ``top - 1`` one bit further, ascending, what the nodes up to the root make of a deeper estimate."""
    prefix = nodes & tb.U(511)
    leaf = prefix >= 256
    g = (nodes[leaf] >> tb.U(9)) << tb.U(8) | prefix[leaf] & tb.U(255)
    below = [values[(prefix >= 1 << level) & (prefix < 2 << level)] for level in range(8)]
    tree = Tree(g, values[leaf], top - 1, 0, below)
    keys, a, b = [], [], []
    for level in range(8):
        first = np.flatnonzero(np.r_[True, (g >> tb.U(7 - level))[1:] != (g >> tb.U(7 - level))[:-1]]) if len(g) else np.zeros(0, np.int64)
        x, y = tree.estimate(level)
        keys.append((g[first] >> tb.U(8)) << tb.U(9) | tb.U(2 << level) | (g[first] & tb.U(255)) >> tb.U(7 - level))
        a.append(x[first])
        b.append(y[first])
    key, a, b = np.concatenate(keys), np.concatenate(a), np.concatenate(b)
    order = np.argsort(key)
    return key[order], a[order], b[order]


_VALUED = "bucket int, grams binary, logp binary"


def fit(docs: DataFrame, depth: int = DEPTH, buckets: int = 1) -> DataFrame:
    """``(bucket, grams, logp)`` of all grams of ``docs`` (text, held_out), learned from the rows not held out, packed by look-up bucket."""
    top = min(TOP, depth)
    packed = docs.mapInArrow(lambda it: _count(it, depth, buckets), _COUNTED)
    trees = cut(packed.groupBy("bucket").applyInArrow(lambda t: _tree(t, depth, top), _TREE), "ctw-trees")

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(expand(r["node"], tb.U, True).view(np.int64)), pa.array(expand(r["value"], np.float64))], ["node", "value"])

    found = trees.select("node", "value").mapInArrow(nodes, "node long, value double").groupBy("node").agg(F.sum("value").alias("value")).toArrow()  # contexts of two bytes at most
    found = found.sort_by("node")
    tables = _above(np.asarray(found.column("node"), np.int64).view(tb.U), np.asarray(found.column("value"), np.float64), top) if top else None
    shared = docs.sparkSession.sparkContext.broadcast(tables)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                g, n = expand(r["grams"], tb.U, True), expand(r["counts"], np.int64)
                total = np.zeros(len(g))
                for start, end in _forest(g, depth, top):
                    own, tree = g[start:end], Tree(g[start:end], n[start:end], depth, top)
                    over = _parent(own >> tb.U(8 * (depth - top + 1)) << tb.U(8), top) << tb.U(9)
                    for level in range(8):
                        p = tree.estimate(level)[0]
                        if shared.value is not None:
                            keys, a, b = shared.value
                            at = np.searchsorted(keys, over | tb.U(2 << level) | (own & tb.U(255)) >> tb.U(7 - level))
                            p = a[at] + b[at] * p
                        total[start:end] += np.log10(p)
                logp = ((total.astype(np.float32).view(np.uint32) + np.uint32(128)) & np.uint32(0xFFFFFF00)).view(np.float32)
                for b, rows in _dealt(context(g, depth, NEAR), buckets):
                    yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([squeeze(g[rows], True)], pa.binary()), pa.array([squeeze(logp[rows])], pa.binary())], ["bucket", "grams", "logp"])

    return trees.select("grams", "counts").mapInArrow(final, _VALUED)


_PACKED = "bucket int, chunk long, docs int, grams binary, words binary, counts binary, ids array<long>, held array<boolean>, sizes binary, texts binary"


def _pack(batches: Iterator[pa.RecordBatch], depth: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Chunks of texts: their distinct grams, and their words with training counts, by look-up bucket; one bucket bears the texts."""
    pid, serial, size, raw = TaskContext.get().partitionId(), 0, 0, []
    keys, words, counts, ids, held, texts, sizes = [], [], [], [], [], [], []
    kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 3, pa.list_(pa.int64()), pa.list_(pa.bool_()), *[pa.binary()] * 2]

    def emit() -> Iterator[pa.RecordBatch]:
        keys.append(_drained(raw)[0])
        g = _drained(keys)[0]
        w, c = _merge(words, counts)
        by_gram = dict(_dealt(context(g, depth, NEAR), buckets))
        by_word = dict(_dealt(w, buckets))
        bearer, none = (pid + serial) % buckets, np.zeros(0, np.int64)
        for b in sorted({bearer, *by_gram, *by_word}):  # one row a batch: a chunk is never copied as a whole
            at, own = by_gram.get(b, none), by_word.get(b, none)
            mine = (ids, held, np.concatenate(sizes).tobytes(), _TEXT.compress(b"".join(texts), asbytes=True)) if b == bearer else ([], [], b"", b"")
            row = (b, (pid << 32) + serial, len(ids), squeeze(g[at], True), squeeze(w[own], True), squeeze(c[own]), *mine)
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], [f.split()[0] for f in _PACKED.split(", ")])

    for batch in batches:
        for part in tb.pieces(batch, limit=PIECE_BYTES):
            data, off = tb.flat(part.column("text"))
            data = tb.FOLD[data]
            own = np.asarray(part.column("held_out").to_numpy(zero_copy_only=False), bool)
            raw.append(grams(data, off, depth)[0])
            if sum(map(len, raw)) >= SORTED:
                keys.append(_drained(raw)[0])
            starts, ends, row = tb.words(data, off)
            h = tb.span_hashes(data, starts, ends)
            w, (learned, n) = _unique(h)[0], _unique(h[~own[row]])
            words.append(w)
            counts.append(np.zeros(len(w), np.int64))
            counts[-1][np.searchsorted(w, learned)] = n
            texts.append(data.tobytes())
            sizes.append(np.diff(off).astype(np.int64))
            ids += part.column("doc_id").to_pylist()
            held += own.tolist()
            size += len(data)
            if size >= CHUNK_BYTES:
                yield from emit()
                keys, words, counts, ids, held, texts, sizes, size = [], [], [], [], [], [], [], 0
                serial += 1
                hand_back()
    if ids:
        yield from emit()


_CARRIED = ("docs", "ids", "held", "sizes", "texts")
_ANSWER = {"bucket": pa.int32(), "buckets": pa.int32(), "chunk": pa.int64(), "logp": pa.binary(), "trained": pa.binary(), "distinct": pa.int64(), "docs": pa.int32(), "ids": pa.list_(pa.int64()), "held": pa.list_(pa.bool_()), "sizes": pa.binary(), "texts": pa.binary()}
_ANSWERS = "bucket int, buckets int, chunk long, logp binary, trained binary, distinct long, docs int, ids array<long>, held array<boolean>, sizes binary, texts binary"


def _answer(t: pa.Table, table: pa.Table, buckets: int) -> pa.Table:
    """To each chunk that asks a look-up bucket: the values of its grams and the training counts of its words, in their order."""
    rows = t.to_pylist()
    if not rows:
        return pa.Table.from_pylist([], pa.schema(list(_ANSWER.items())))
    parts = table.select(["grams", "logp"]).to_pylist()
    keys = np.concatenate([np.zeros(0, tb.U), *(expand(r["grams"], tb.U, True) for r in parts)])
    logp = np.concatenate([np.zeros(0, np.float32), *(expand(r["logp"], np.float32) for r in parts)])
    order = np.argsort(keys)
    keys, logp = keys[order], logp[order]
    words = [expand(r["words"], tb.U, True) for r in rows]
    every, inv = np.unique(np.concatenate(words), return_inverse=True)
    trained = np.bincount(inv, weights=np.concatenate([expand(r["counts"], np.int64) for r in rows]), minlength=len(every)).astype(np.int64)
    out, at = [], 0
    for k, (r, w) in enumerate(zip(rows, words, strict=True)):
        out.append(
            {x: r[x] for x in ("bucket", "chunk", *_CARRIED)}
            | {"buckets": buckets, "logp": squeeze(logp[np.searchsorted(keys, expand(r["grams"], tb.U, True))]), "trained": squeeze(trained[inv[at : at + len(w)]])}
            | {"distinct": int((trained > 0).sum()) if k == 0 else 0}
        )
        at += len(w)
    del parts, rows, keys, logp, order, words, every, inv, trained
    hand_back()
    return pa.Table.from_pylist(out, pa.schema(list(_ANSWER.items())))


class Lookup:
    """32-bit values of distinct words, in a table of two to four times as many places: a word stands at its hash or the next free place.

    A place holds 32 further bits of the word's hash above its value. No two words agree in all bits that are held, or
    another seed is taken; a word that the table has is thus never taken for another. Nobody may ask for other words.
    """

    def __init__(self, words: np.ndarray, values: np.ndarray):
        self.kind, self.seed, self.bits, few = values.dtype, 0, max(1, (2 * len(words)).bit_length()), tb.U(len(words).bit_length())
        while True:
            h = self._hash(words)
            order = np.sort(h >> few << few | np.arange(len(h), dtype=tb.U))
            top, order = order >> few, (order & tb.U((1 << int(few)) - 1)).astype(np.int64)
            twins = np.flatnonzero(top[1:] == top[:-1])
            h = h[order]
            held = np.c_[self._place(h), (h & _LOW_HALF).astype(np.int64)][np.union1d(twins, twins + 1)]
            if len(np.unique(held, axis=0)) == len(held):
                break
            self.seed += 1
        n = np.arange(len(h))
        at = np.maximum.accumulate(self._place(h) - n) + n if len(h) else n  # each at its place or behind the last
        self.table = np.zeros(max(1 << self.bits, int(at[-1]) + 1 if len(at) else 0), tb.U)
        self.table[at] = (h << tb.U(32)) | np.ascontiguousarray(values).view(np.uint32)[order]

    def _hash(self, words: np.ndarray) -> np.ndarray:
        return tb.mix(words ^ tb.U(self.seed))

    def _place(self, h: np.ndarray) -> np.ndarray:
        return (h >> tb.U(64 - self.bits)).astype(np.int64)

    def __call__(self, words: np.ndarray) -> np.ndarray:
        """The value of each of ``words``, all of which the table has."""
        out = np.empty(len(words), np.uint32)
        for a in range(0, len(words), FEW):  # as many as caches hold
            h = self._hash(words[a : a + FEW])
            at, mark = self._place(h), h & _LOW_HALF
            got = self.table[at]
            out[a : a + FEW] = got
            todo = np.flatnonzero(got >> tb.U(32) != mark)
            while len(todo):
                at[todo] += 1
                here = self.table[at[todo]]
                out[a + todo] = here
                todo = todo[here >> tb.U(32) != mark[todo]]
        return out.view(self.kind)


_SCORED = "doc_id long, held_out boolean, symbols long, n_tokens long, n_known long, sums double, score double, distinct long"


def _texts(t: pa.Table, depth: int) -> pa.Table:
    """One row per text of a chunk: its grams and words looked up among the answers."""
    rows = sorted(t.to_pylist(), key=lambda r: r["bucket"])
    bearer = next(r for r in rows if r["sizes"])
    n, buckets = bearer["docs"], bearer["buckets"]
    off = np.r_[0, np.cumsum(np.frombuffer(bearer["sizes"], np.int64))]
    data = np.frombuffer(_TEXT.decompress(bearer["texts"], int(off[-1]), asbytes=True) if off[-1] else b"", np.uint8)
    edges, a = [0], 0
    while a < n:  # about PIECE_BYTES at a time
        a = min(n, max(a + 1, int(np.searchsorted(off, off[a] + PIECE_BYTES, "right")) - 1))
        edges.append(a)
    part = lambda a, z: (data[off[a] : off[z]], off[a : z + 1] - off[a])
    hashes = lambda a, z: (lambda starts, ends, row: (tb.span_hashes(data[off[a] : off[z]], starts, ends), row))(*tb.words(*part(a, z)))
    symbols, tokens_of, raw, own, heard = [], [], [], [], []
    for a, z in pairwise(edges):
        key, edge = grams(*part(a, z), depth)
        symbols.append((key, edge))
        raw.append(key)
        if sum(map(len, raw)) >= SORTED:
            own.append(_drained(raw)[0])
        h, row = hashes(a, z)
        tokens_of.append((h, row.astype(np.int32)))
        heard.append(_unique(h)[0])
    own.append(_drained(raw)[0])
    keys, words = _drained(own)[0], _drained(heard)[0]
    logp, values = np.empty(len(keys), np.float32), {r["bucket"]: r.pop("logp") for r in rows}
    for b, at in _dealt(context(keys, depth, NEAR), buckets):
        logp[at] = expand(values.pop(b), np.float32)
    trained = np.empty(len(words), np.int64)
    trained[np.argsort(bucket_of(words, buckets), kind="stable")] = np.concatenate([expand(r["trained"], np.int64) for r in rows])
    logp_of, number_of = Lookup(keys, logp), Lookup(words, np.arange(len(words), dtype=np.uint32))
    del keys, logp, words
    score, sums, known, tokens = np.zeros(n), np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for k, (a, z) in enumerate(pairwise(edges)):
        (key, edge), (h, row) = symbols[k], tokens_of[k]
        symbols[k] = tokens_of[k] = None
        so_far = np.r_[0.0, np.cumsum(logp_of(key), dtype=np.float64)]
        score[a:z] = so_far[edge[1:]] - so_far[edge[:-1]]
        c = trained[number_of(h)]
        sums[a:z] = np.bincount(row, weights=np.log10(c + 0.5), minlength=z - a)
        known[a:z] = np.bincount(row, weights=c > 0, minlength=z - a)
        tokens[a:z] = np.bincount(row, minlength=z - a) + 1
    distinct = np.zeros(n, np.int64)
    distinct[0] = sum(r["distinct"] for r in rows)
    del symbols, tokens_of, logp_of, number_of, trained, values, so_far, key, h, row, c, data
    hand_back()
    return pa.table({"doc_id": pa.array(bearer["ids"], pa.int64()), "held_out": pa.array(bearer["held"]), "symbols": pa.array(np.diff(off) + 1), "n_tokens": pa.array(tokens), "n_known": pa.array(known), "sums": pa.array(sums), "score": pa.array(score), "distinct": pa.array(distinct)})


def score(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte)`` of every row; the end symbol counts as a byte."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out().alias("held_out"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("n")).first()["n"]
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    table = fit(rows.select("text", "held_out"), depth, buckets)
    packed = rows.mapInArrow(lambda it: _pack(it, depth, buckets), _PACKED)
    answers = packed.groupBy("bucket").cogroup(table.groupBy("bucket")).applyInArrow(lambda t, table: _answer(t, table, buckets), _ANSWERS)
    texts = cut(answers.groupBy("chunk").applyInArrow(lambda t: _texts(t, depth), _SCORED), "ctw-texts")
    train = F.when(~F.col("held_out"), F.col("n_tokens"))
    stats = texts.agg(F.coalesce(F.sum(train), F.lit(0)).alias("n"), F.count(train).alias("ends"), F.coalesce(F.sum("distinct"), F.lit(0)).alias("v")).first()
    n, ends = stats["n"], stats["ends"]
    v = stats["v"] + (1 if ends else 0)
    unit = math.log10(n + 0.5 * (v + 1))
    return texts.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.lit(1 if ends else 0)).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("sums") + F.lit(math.log10(ends + 0.5)) - F.col("n_tokens") * F.lit(unit)).alias("base_score"), "score", (F.col("score") * F.lit(-math.log2(10)) / F.col("symbols")).alias("bits_per_byte"),
    )
