"""Packing token sequences by a configuration linear program over the length histogram.

Documents become pieces of at most ``capacity`` tokens. A configuration is a multiset of piece lengths that
fits one sequence. The covering program (every length as often as the histogram says, few configurations) is
solved by multiplicative weights: a length's price decays with the share of its demand already covered, a
knapsack dynamic program over the capacity prices configurations, and every configuration within a small
factor of the best is raised by a small step. The fractional solution is rounded down; what it leaves over
is placed best-fit in decreasing length, on counts of equal lengths and equal gaps rather than on items.
Everything the driver holds is bounded by the capacity and the number of configurations, not by the rows.
Pieces then find their sequence by their rank among pieces of equal length.

Tokens. White space ends every token of the vocabulary's pre-tokeniser and leaves none behind, so a text's
ids are the ids of its white-space separated parts in a row; parts are encoded once and kept in a bounded
cache.

Nulls and edge cases: null and empty texts are the end id alone; rows with equal or null doc_ids are packed
each for itself; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ternion.llm import textbytes as tb
from ternion.llm.tables import handing_back, small_batches
from ternion.plans.lineage import cut

CAPACITY, END_ID, CACHE_PARTS = 2048, 0, 500_000
ROUNDS, NEAR, STEP = 200, 0.005, 0.04
#: Latin or Cyrillic letters between ASCII punctuation, but for the apostrophe (contractions), the signs of special
#: tokens, and the letter whose lower case has a mark, which would join the punctuation behind it.
SIMPLE = re.compile(r'([!-&(-/:;=?@\[-`{}~]*)([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f\u0400-\u0481\u048a-\u052f]+)([!-&(-/:;=?@\[-`{}~]*)')
WORD_END = "</w>"


class Encoder:
    """Little-endian ids of texts, by parts between white space.

    A part that is ``SIMPLE`` letters between punctuation is one pre-token of each kind, so its ids are those of the
    punctuation and of the lower-case letters; such pieces are encoded many at a time and cut at the ids that
    end a pre-token. Other parts are encoded whole.

    The caches have two generations: when the young one is full it becomes the old one, and parts found there
    move back, so frequent parts stay.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {"": b""}

    def __call__(self, text: str) -> bytes:
        parts = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        if missing := set(parts).difference(self.young):
            if len(self.young) > CACHE_PARTS:
                self.old, self.young, self.units = self.young, {"": b""}, {"": b""}
                missing = set(parts).difference(self.young)
            self._learn(missing)
        return b"".join(map(self.young.__getitem__, parts))

    def _learn(self, missing: set[str]) -> None:
        young, old, units = self.young, self.old, self.units
        split, whole, new = [], [], {}
        for p in missing:
            if (got := old.get(p)) is not None:
                young[p] = got
                continue
            found = SIMPLE.fullmatch(p)
            if found is None:
                whole.append(p)
                continue
            head, core, tail = found.groups()
            low = core.lower() if core.isascii() else core
            pieces = head, p if low == p else low, tail  # one string for both caches
            split.append((p, pieces))
            for u in pieces:
                if u not in units:
                    new[u] = None
        units.update(self._units(list(new)))
        for p, (head, core, tail) in split:
            young[p] = units[head] + units[core] + units[tail]
        young.update(self._each(whole))

    def _units(self, new: list[str]) -> dict[str, bytes]:
        """Ids of strings of one pre-token each; every string gives one at least, so equal counts mean one each."""
        if not new:
            return {}
        ids = np.array(self.encode([" ".join(new)], add_special_tokens=False)[0].ids, "<u4")
        to = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(to) != len(new) or to[-1] != 4 * len(ids):
            return self._each(new)
        raw = ids.tobytes()
        return {u: raw[a:b] for u, a, b in zip(new, [0, *to], to)}

    def _each(self, new: list[str]) -> dict[str, bytes]:
        return {p: array("I", e.ids).tobytes() for p, e in zip(new, self.encode(new, add_special_tokens=False), strict=True)} if new else {}


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file; Python workers keep it from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, pid, k)``; (pid, length, k) numbers the pieces of a length in a task."""
    end = np.array([END_ID], "<u4").tobytes()

    @handing_back
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, pid, seen = encoder(tokenizer), TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            for part in tb.pieces(batch):
                rows: list[tuple] = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    ids = encode(text or "") + end
                    for p, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        n = len(own) // 4
                        rows.append((doc_id, p, at // 4, n, zlib.crc32(own), pid, seen[n]))
                        seen[n] += 1
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32", "pid", "k"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(pieces, "doc_id long, piece int, start long, length long, ids_crc32 long, pid int, k long")


def _prices(lengths: np.ndarray, price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack: the best value of each capacity and the index of one item in it (-1: one unit unused)."""
    best, item = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    reach = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if n := reach[c]:
            value = price[:n] + best[c - lengths[:n]]
            j = int(value.argmax())
            if value[j] > best[c] + 1e-15:
                best[c], item[c] = value[j], j
    return best, item


def configurations(lengths: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = ROUNDS) -> dict[tuple[int, ...], float]:
    """A fractional cover of the demand: configurations (ascending indices of lengths) with their amounts."""
    amount: dict[tuple[int, ...], float] = {}
    covered = np.zeros(len(lengths))
    decay = math.log(len(lengths) + 1) + 1.0
    for _ in range(rounds):
        share = covered / demand
        price = np.where(share < 1.0, lengths / capacity * np.exp(-decay * share), 0.0)
        if not price.any():
            break
        best, item = _prices(lengths, price, capacity)
        value = price + best[capacity - lengths]
        order = np.flatnonzero((price > 0) & (value >= (1.0 - NEAR) * best[capacity]))
        for j in order[np.argsort(share[order], kind="stable")]:
            if covered[j] >= demand[j]:
                continue
            used, c = [int(j)], capacity - int(lengths[j])
            while c > 0:
                if item[c] < 0:
                    c -= 1
                else:
                    used.append(int(item[c]))
                    c -= int(lengths[item[c]])
            kinds, counts = np.unique(used, return_counts=True)
            step = max(1e-9, STEP * float((demand[kinds] / counts).min()))
            room = float(((demand[kinds] - covered[kinds]) / counts).min())
            if room <= 0:
                continue
            step = min(step, room)
            covered[kinds] += step * counts
            key = tuple(sorted(used))
            amount[key] = amount.get(key, 0.0) + step
    return amount


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (lengths in order, how many): exactly the histogram's pieces, each sequence within capacity."""
    left = {n: c for n, c in histogram.items() if c > 0}
    out: list[tuple[tuple[int, ...], int]] = []
    if left.get(capacity):
        out.append(((capacity,), left.pop(capacity)))
    if left:
        lengths = np.array(sorted(left), np.int64)
        demand = np.array([left[n] for n in lengths.tolist()], float)
        for used, x in sorted(configurations(lengths, demand, capacity).items(), key=lambda kv: (-kv[1], kv[0])):
            kinds, counts = np.unique(used, return_counts=True)
            names = lengths[kinds].tolist()
            n = min(int(x + 1e-9), *(left[a] // int(c) for a, c in zip(names, counts, strict=True)))
            if n > 0:
                for a, c in zip(names, counts, strict=True):
                    left[a] -= n * int(c)
                out.append((tuple(sorted((int(lengths[u]) for u in used), reverse=True)), n))
    return out + _best_fit(left, capacity, out)


def _best_fit(left: dict[int, int], capacity: int, placed: list[tuple[tuple[int, ...], int]]) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing of counted lengths into new sequences and the gaps of ``placed``, which it rewrites."""
    groups: dict[int, list[list]] = {}
    for used, n in placed:
        groups.setdefault(capacity - sum(used), []).append([used, n])
    placed.clear()
    for size in sorted((n for n, c in left.items() if c > 0), reverse=True):
        need = left[size]
        while need:
            gap = min((g for g in groups if g >= size and groups[g]), default=None)
            if gap is None:
                per = capacity // size
                for k, n in ((per, need // per), (need % per, 1)):
                    if k and n:
                        groups.setdefault(capacity - k * size, []).append([(size,) * k, n])
                break
            entry = groups[gap][-1]
            fits = gap // size
            n, k = (min(entry[1], need // fits), fits) if need >= fits else (1, need)
            groups.setdefault(gap - k * size, []).append([(*entry[0], *(size,) * k), n])
            entry[1] -= n
            if not entry[1]:
                groups[gap].remove(entry)
            need -= n * k
    merged: dict[tuple[int, ...], int] = {}
    for entries in groups.values():
        for used, n in entries:
            merged[used] = merged.get(used, 0) + n
    return list(merged.items())


def _runs(sequences: list[tuple[tuple[int, ...], int]], capacity: int) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first rank, first sequence number and offset of each run of equal places."""
    rank, rows, base = {}, {}, 0
    for used, n in sequences:
        offset = 0
        for size in used:
            rows.setdefault(size, []).append((rank.get(size, 0), base, offset))
            rank[size] = rank.get(size, 0) + n
            offset += size
        base += n
    return {k: tuple(np.array(x, np.int64) for x in zip(*v, strict=True)) for k, v in rows.items()}


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` per piece."""
    small_batches(docs.sparkSession)
    pieces = cut(cut_pieces(docs, tokenizer, capacity), "pack-pieces")
    counts = cut(pieces.groupBy("pid", "length").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # a row a length
    runs = _runs(plan(histogram, capacity), capacity)
    base = counts.select("pid", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("pid")) - F.col("n")).alias("base"))

    @handing_back
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.asarray(batch.column("length"), np.int64)
            rank = np.asarray(batch.column("k"), np.int64) + np.asarray(batch.column("base"), np.int64)
            seq, off = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            order = np.argsort(size, kind="stable")
            kinds, at = np.unique(size[order], return_index=True)
            for n, rows in zip(kinds.tolist(), np.split(order, at[1:]), strict=True):
                first, base_seq, offset = runs[n]
                i = np.searchsorted(first, rank[rows], "right") - 1
                seq[rows], off[rows] = base_seq[i] + rank[rows] - first[i], offset[i]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(seq), pa.array(off)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return pieces.join(base, ["pid", "length"]).mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
