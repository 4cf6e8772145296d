"""Scoring finds the values of grams and words by their hashes, exactly; counts take few bytes."""

import numpy as np
import pytest

pytest.importorskip("ternion.llm")
from ternion.llm import ctw
from ternion.llm import textbytes as tb


@pytest.mark.parametrize("n", [0, 1, 2, 3, 100, 70_000])
@pytest.mark.parametrize("kind", [np.uint32, np.float32])
def test_lookup_gives_each_word_its_value(n, kind):
    rng = np.random.default_rng(n)
    words = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
    values = rng.integers(0, 1 << 30, len(words)).astype(np.uint32).view(kind)
    asked = rng.integers(0, max(1, len(words)), 3 * n)
    assert (ctw.Lookup(words, values)(words[asked]) == values[asked]).all()


def test_words_whose_hashes_crowd_or_meet(monkeypatch):
    """All at one place; and equal in all bits that are held until another seed is taken."""
    words = np.arange(1, 400, dtype=np.uint64)
    values = np.arange(len(words), dtype=np.uint32)
    with monkeypatch.context() as m:
        m.setattr(ctw.Lookup, "_hash", lambda self, w: w | tb.U(0xFF << 56))
        assert (ctw.Lookup(words, values)(words) == values).all()
    with monkeypatch.context() as m:
        m.setattr(ctw.Lookup, "_hash", lambda self, w: tb.mix(w ^ tb.U(self.seed)) if self.seed else tb.mix(w // tb.U(2)))
        found = ctw.Lookup(words, values)
        assert found.seed == 1 and (found(words) == values).all()


def test_counts_take_the_bytes_that_they_need():
    for most, width in ((255, 1), (256, 2), (1 << 20, 4), (1 << 40, 8)):
        x = np.r_[np.arange(200), most].astype(np.int64)
        raw = ctw.squeeze(x)
        assert (raw[7] or 8) == width and (ctw.expand(raw, np.int64) == x).all()
    assert len(ctw.expand(ctw.squeeze(np.zeros(0, np.int64)), np.int64)) == 0
