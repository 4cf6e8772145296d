"""What workers keep between tasks: freed memory goes back to the system after every batch, and executors' heaps shrink before packing."""

import pyarrow as pa
import pytest

pytest.importorskip("ternion.llm")
import corpus_pipeline
from ternion.llm import minhash, packing, tables, toxicity


def test_tasks_hand_memory_back_after_each_batch(monkeypatch):
    calls = []
    monkeypatch.setattr(tables, "hand_back", lambda: calls.append(1))
    texts = pa.array(["a b c d e f", None, ""])
    n = pa.array([1, 2, 3], pa.int64())
    signed = pa.RecordBatch.from_pydict({"doc_id": n, "digest": pa.array([b"x"] * 3), "text": texts})
    marked = pa.RecordBatch.from_pydict({"doc_id": n, "toxic": pa.array([0, 1, 0], pa.int32()), "text": texts})
    paired = pa.RecordBatch.from_pydict({"a": n, "b": n, "ta": texts, "tb": texts})
    for work, batch, rest in ((minhash._keys, signed, (2, 2)), (toxicity._terms, marked, ()), (minhash._compare, paired, ())):
        calls.clear()
        assert sum(b.num_rows for b in work(iter([batch] * 4), *rest)) == 12
        assert len(calls) == 5  # after each, and at the end


def test_executors_shrink_before_packing(spark, monkeypatch):
    order = []
    real = corpus_pipeline.shrink_executors
    monkeypatch.setattr(corpus_pipeline, "shrink_executors", lambda s: (order.append("shrink"), real(s)))
    monkeypatch.setattr(packing, "pack", lambda docs, path: order.append("pack"))
    corpus_pipeline.pack_sequences(spark, None, "")
    assert order == ["shrink", "pack"]
