"""What a task of the context tree holds: little beyond the grams that it counts, and the nodes of a few trees at a time."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("ternion.llm")
from ternion.llm import ctw

SCHEMA = "doc_id long, text string"


def peak(f):
    """What ``f`` returns, and the most bytes that were held meanwhile."""
    tracemalloc.start()
    try:
        return f(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def noise(texts, size):
    rng = np.random.default_rng(5)
    return [rng.integers(97, 117, size, np.uint8).tobytes().decode() for _ in range(texts)]


def test_counting_holds_its_grams_little_more_than_once():
    batches = [pa.RecordBatch.from_pydict({"text": [t], "held_out": [k % 5 == 1]}) for k, t in enumerate(noise(50, 100_000))]

    def count():
        rows = symbols = 0
        for b in ctw._count(iter(batches), ctw.DEPTH, 100):
            rows += int.from_bytes(b.column("grams")[0].as_py()[:8], "little")
            symbols += int(ctw.expand(b.column("counts")[0].as_py(), np.int64).sum())
        return rows, symbols

    count()  # tables of powers and code are made once
    (rows, symbols), most = peak(count)
    assert rows > 4_900_000 and symbols == 40 * 100_001
    assert most < 40 * rows  # a gram and its count have 16 bytes


def test_a_bucket_evaluates_few_trees_at_a_time():
    rng = np.random.default_rng(6)
    g = np.unique(rng.integers(0, 1 << 63, 800_000, np.uint64))
    t = pa.table({"bucket": pa.array([0], pa.int32()), "grams": pa.array([ctw.squeeze(g, True)], pa.binary()), "counts": pa.array([ctw.squeeze(np.ones(len(g), np.int64))], pa.binary())})
    _, most = peak(lambda: ctw._tree(t, ctw.DEPTH, ctw.TOP))
    assert most < 500 * len(g)


def test_few_grams_and_trees_at_a_time_give_the_same(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, "".join(rng.choices("ab cdé", k=rng.randint(0, 60)))) for i in range(80)] + [(None, None), (7, ""), (90, "abcabcabc" * 9)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for depth in (0, 2, ctw.DEPTH):
        take = lambda: sorted((r.doc_id or -1, round(r.score, 3), round(r.base_score, 6)) for r in ctw.score(docs, depth).collect())  # noqa: B023, E731
        with monkeypatch.context() as m:
            want = take()
            m.setattr(ctw, "GRAMS", 100)
            m.setattr(ctw, "WAITING", 30)
            m.setattr(ctw, "FOREST", 20)
            assert take() == want


def test_ranges_part_no_run(monkeypatch):
    monkeypatch.setattr(ctw, "FOREST", 4)
    g = np.array([1, 2, 3, 4, 5, 6, 7 << 8, 8 << 8, 9 << 8, 9 << 8 | 1, 10 << 8, 10 << 8 | 1], np.uint64)
    assert list(ctw._forest(g, 1, 1)) == [(0, 6), (6, 10), (10, 12)]
    assert list(ctw._forest(g[:0], 1, 1)) == []


def test_runs_are_dealt_like_rows():
    x = np.repeat(np.random.default_rng(7).permutation(500).astype(np.uint64), 3)
    to = ctw.bucket_of(x, 17)
    got = dict(ctw._dealt(x, 17))
    assert set(got) == set(to.tolist()) and all((at == np.flatnonzero(to == b)).all() for b, at in got.items())
    assert not list(ctw._dealt(x[:0], 17))
