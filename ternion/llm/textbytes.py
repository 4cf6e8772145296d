"""Whole-column work on UTF-8 text in numpy: no loop over words or characters.

Words are maximal runs of bytes other than ASCII white space (0x20, 0x09-0x0D). A word's hash is a
polynomial over its bytes (random table entry per byte, arithmetic modulo 2**64) followed by a
finaliser. Case is kept unless the caller folds it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_BYTES = 1 << 20
SHINGLE = 5

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, a bijection of 64-bit words."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random odd-or-even 64-bit words."""
    return mix(np.arange(1, n + 1, dtype=U) * U(_BASE) + U(seed & (2**64 - 1)))


_BYTE = seeded(256, 0xB17E)
_POWERS = [np.ones(1, U), np.ones(1, U)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, BATCH_BYTES)
        for k, factor in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, factor, U)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=U)
    return _POWERS[0][:n], _POWERS[1][:n]


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column laid end to end, and its offsets (one more than rows). Null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0] : off[-1]] if raw is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return data, off - off[0]


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of whole rows with about ``limit`` bytes of text each (one row at least)."""
    n = batch.num_rows
    if not n:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < n:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def words(data: np.ndarray, off: np.ndarray, apart: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of all maximal runs of bytes that ``apart`` doesn't mark."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    solid = ~apart[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    edges = off[(off > 0) & (off < len(data))]
    first[edges] = solid[edges]
    last[edges - 1] = solid[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(off, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``data``; equal bytes have equal hashes wherever they stand."""
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U)
    np.cumsum(_BYTE[data] * power[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every window of ``width`` bytes."""
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U)
    np.cumsum(_BYTE[data] * power[: len(data)], out=sums[1:])
    n = len(data) - width + 1
    return mix((sums[width:] - sums[:n]) * inverse[:n])


_PLACE = seeded(SHINGLE, 0x51) | U(1)


def shingles(hashes: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of five words with their row numbers, ordered by row.

    A row of one to four words has one shingle, made of all its words; a row without words has none.
    """
    n = np.bincount(row, minlength=rows) if len(row) else np.zeros(rows, np.int64)
    lead = np.cumsum(n) - n
    count = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(rows), count)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + lead[owner]
    total = np.zeros(len(owner), U)
    room = n[owner]
    for k in range(SHINGLE):
        inside = room > k
        total[inside] += hashes[at[inside] + k] * _PLACE[k]
    return mix(total + np.minimum(room, SHINGLE).astype(U)), owner


def bag(sh: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each row in ascending order, their rows and multiplicities."""
    if not len(sh):
        return sh, owner, np.zeros(0, np.int64)
    sh = sh.copy()
    cuts = np.flatnonzero(np.diff(owner)) + 1
    for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(sh)], strict=True):
        sh[a:b].sort()
    new = np.r_[True, (sh[1:] != sh[:-1]) | (owner[1:] != owner[:-1])]
    at = np.flatnonzero(new)
    return sh[at], owner[at], np.diff(np.r_[at, len(sh)])


def row_bags(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`bag` of the word shingles of every text of a column."""
    data, off = flat(column)
    starts, ends, row = words(data, off)
    sh, owner = shingles(span_hashes(data, starts, ends), row, len(off) - 1)
    return bag(sh, owner)
