"""Suffix order and common prefixes of one shard by external induced sorting.

Suffix tuples (position, common prefix with their predecessor) wait in queues keyed by their first symbol.
The smallest queue is taken, its tuples get their place, and each induces the suffix one position to the
left, whose common prefix is one more than the least common prefix met since its queue was last fed. One
pass in ascending order places suffixes that are larger than their successors, one in descending order the
others. Equal first symbols are taken in rounds, so every step handles a whole array of tuples. Queues
spill to an unnamed temporary file beyond a memory budget; the file goes with the task.

Comparisons never need more than ``limit`` symbols. The induction starts from the left-most smaller suffixes,
and as these differ from one another within ``limit`` symbols or not at all that matters, they are ordered by
words of eight symbols, refining only ties, which is where the recursion ends.
"""

from __future__ import annotations

import tempfile

import numpy as np

MEMORY_TUPLES = 8_000_000


class Queues:
    """First-in first-out arrays by symbol, spilled in arrival order."""

    def __init__(self, symbols: int, memory: int = MEMORY_TUPLES):
        self.held: list[list[np.ndarray]] = [[] for _ in range(symbols)]
        self.spilled: list[list[tuple[int, int]]] = [[] for _ in range(symbols)]
        self.size, self.memory, self.file = 0, memory, None

    def push(self, symbol: int, tuples: np.ndarray) -> None:
        self.held[symbol].append(tuples)
        self.size += len(tuples)
        if self.size > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for symbol, parts in enumerate(self.held):
            for part in parts:
                self.spilled[symbol].append((self.file.tell(), len(part)))
                self.file.write(part.tobytes())
            parts.clear()
        self.size = 0

    def pop(self, symbol: int) -> np.ndarray:
        """All tuples waiting under a symbol; they are gone afterwards."""
        parts = []
        for at, n in self.spilled[symbol]:
            self.file.seek(at)
            parts.append(np.frombuffer(self.file.read(16 * n), np.int64).reshape(n, 2))
        parts += self.held[symbol]
        self.size -= sum(len(p) for p in self.held[symbol])
        self.held[symbol], self.spilled[symbol] = [], []
        return np.concatenate(parts) if parts else np.zeros((0, 2), np.int64)

    def waiting(self, symbol: int) -> bool:
        return bool(self.held[symbol] or self.spilled[symbol])

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _words(text: np.ndarray) -> np.ndarray:
    """Big-endian words of eight symbols from every position."""
    wide = np.r_[text, np.zeros(8, np.uint8)]
    word = np.zeros(len(text), np.uint64)
    for k in range(8):
        word = word << np.uint64(8) | wide[k : k + len(text)].astype(np.uint64)
    return word


def _start_order(text: np.ndarray, word: np.ndarray, at: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Left-most smaller suffixes in order, with common prefixes: by words, refining ties only."""
    pad = np.r_[word, np.zeros(limit + 8, np.uint64)]
    order = at[np.argsort(pad[at], kind="stable")]
    lcp = np.full(len(order), limit, np.int64)
    group = np.zeros(len(order), np.int64)
    todo = np.arange(len(order))
    for depth in range(0, limit, 8):
        if depth:
            own = order[todo]
            sort = np.lexsort((pad[own + depth], group[todo]))
            order[todo] = own[sort]
        w = pad[order[todo] + depth]
        new = np.ones(len(todo), bool)
        new[1:] = (w[1:] != w[:-1]) | (group[todo[1:]] != group[todo[:-1]])
        inner = np.flatnonzero(new)[1:]
        inner = inner[group[todo[inner]] == group[todo[inner - 1]]]
        inner = inner[todo[inner] == todo[inner - 1] + 1]
        x = w[inner] ^ w[inner - 1]
        same = np.zeros(len(x), np.int64)
        for k in range(1, 8):
            same += (x >> np.uint64(64 - 8 * k)) == 0
        lcp[todo[inner]] = np.minimum(limit, depth + same)
        group[todo] = np.maximum.accumulate(np.where(new, todo, 0))
        tied = np.zeros(len(todo), bool)
        tied[1:] |= ~new[1:]
        tied[:-1] |= ~new[1:]
        todo = todo[tied]
        if not len(todo):
            break
    if len(lcp):
        lcp[0] = 0
    return order, lcp


def _common(text: np.ndarray, a: int, b: int, limit: int) -> int:
    """The common prefix of two suffixes, at most ``limit``."""
    n = min(limit, len(text) - a, len(text) - b)
    other = np.flatnonzero(text[a : a + n] != text[b : b + n])
    return int(other[0]) if len(other) else n


class _Inducer:
    """Feeds the queues from scanned tuples and keeps the least common prefix since each queue was fed."""

    def __init__(self, text: np.ndarray, takes: np.ndarray, limit: int, symbols: int, memory: int):
        self.text, self.takes, self.limit = text, takes, limit
        self.queues = Queues(symbols, memory)
        self.least = np.full(symbols, limit, np.int64)
        self.fed = np.zeros(symbols, bool)

    def scan(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        if not len(pos):
            return
        left = pos - 1
        good = np.flatnonzero((pos > 0) & self.takes[np.maximum(left, 0)])
        symbol = self.text[left[good]]
        order = np.argsort(symbol, kind="stable")
        good, symbol = good[order], symbol[order]
        kinds, first = np.unique(symbol, return_index=True)
        absent = np.ones(len(self.least), bool)
        absent[kinds] = False
        self.least[absent] = np.minimum(self.least[absent], lcp.min())
        if not len(good):
            return
        for c, at in zip(kinds.tolist(), np.split(good, first[1:]), strict=True):
            stops = np.r_[0, at + 1]
            inside = stops[stops < len(lcp)]
            low = np.minimum.reduceat(lcp, inside)
            own = low[: len(at)].copy()
            own[0] = min(own[0], self.least[c])
            own = np.minimum(own + 1, self.limit)
            if not self.fed[c]:
                own[0], self.fed[c] = 0, True
            self.least[c] = low[len(at)] if len(low) > len(at) else self.limit
            self.queues.push(c, np.stack([left[at], own], 1))


def suffix_order(text: np.ndarray, limit: int = 50, memory: int = MEMORY_TUPLES) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes of ``text`` ordered by their first ``limit`` symbols, and each one's common prefix (at most
    ``limit``) with the one before. Suffixes that agree in ``limit`` symbols stand together in some order."""
    if len(text) and text.max() == 255:
        raise ValueError("symbols go up to 254; UTF-8 has none above 244")
    text = np.r_[text + np.uint8(1), np.uint8(0)]
    n = len(text)
    if n == 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    step = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16))
    at = np.where(step != 0, np.arange(n - 1), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    small = np.ones(n, bool)
    small[:-1] = np.where(at < n, step[np.minimum(at, n - 2)] > 0, False)
    starts = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    order, lcp = _start_order(text, _words(text), starts, limit)
    symbols = 256
    edge = np.searchsorted(text[order], np.arange(symbols + 1))
    up = _Inducer(text, ~small, limit, symbols, memory)
    large: list[tuple[np.ndarray, np.ndarray]] = []
    for c in range(symbols):
        parts, last = [], -1
        while up.queues.waiting(c):
            got = up.queues.pop(c)
            parts.append(got)
            up.scan(got[:, 0], got[:, 1])
        got = np.concatenate(parts) if parts else np.zeros((0, 2), np.int64)
        large.append((got[:, 0], got[:, 1]))
        a, z = edge[c], edge[c + 1]
        if a < z:
            own = lcp[a:z].copy()
            last = int(got[-1, 0]) if len(got) else -1
            own[0] = _common(text, last, int(order[a]), limit) if last >= 0 else 0
            up.scan(order[a:z], own)
    up.queues.close()
    down = _Inducer(text, small, limit, symbols, memory)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for c in range(symbols - 1, -1, -1):
        parts = []
        while down.queues.waiting(c):
            got = down.queues.pop(c)
            parts.append(got)
            down.scan(got[:, 0], got[:, 1])
        if c == 0:  # the end itself has no successor to induce it
            end = np.array([[n - 1, 0]], np.int64)
            parts.append(end)
            down.scan(end[:, 0], end[:, 1])
        got = np.concatenate(parts) if parts else np.zeros((0, 2), np.int64)
        pos, own = large[c]
        large[c] = (pos[:0], own[:0])
        seam = _common(text, int(pos[-1]), int(got[-1, 0]), limit) if len(pos) and len(got) else 0
        if len(pos):
            back = np.r_[seam, own[:0:-1]]
            down.scan(pos[::-1], back)
        s_pos, s_lcp = got[::-1, 0], np.zeros(len(got), np.int64)
        if len(got):
            s_lcp[1:] = got[:0:-1, 1]
            s_lcp[0] = seam
        out.append((np.r_[pos, s_pos], np.r_[own, s_lcp]))
    down.queues.close()
    pos, common = (np.concatenate([x[k] for x in out[::-1]]) for k in (0, 1))
    keep = np.flatnonzero(pos != n - 1)
    gone = int(np.flatnonzero(pos == n - 1)[0])
    if gone + 1 < len(common):
        common[gone + 1] = min(common[gone + 1], common[gone])
    return pos[keep], common[keep]
