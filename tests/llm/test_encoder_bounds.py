"""The packing encoder against the tokenizer itself, and the first bounds of the neighbour search against brute force."""

from array import array

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ternion.llm import ann, packing

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)
ALPHABET = "aAbZéÉßİΣσ'’\"-.,;<|>$_09½１\t\n\r ́ ​﻿日本語。"
ODD = [
    "", "   ", "İstanbul K Å ΣΑΣ don't 'S it's. x's, 're", "<|endoftext|> (<|startoftext|>) a<|b endoftext", "é x́. ́y",
    "a\x0bb \x85 \x1c c", "word-word a.b.c --x-- ... \"q\"", "a̸ = ̸b", "ä" * 5000, "x " * 5000, "가 가",
]


def _plain(text: str) -> bytes:
    return array("I", PLAIN.encode(text, add_special_tokens=False).ids).tobytes()


def test_encoder_on_odd_texts():
    e = packing.Encoder(PATH)
    for text in ODD + ODD[::-1]:
        assert e(text) == _plain(text), text[:60]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=60), max_size=4))
def test_encoder_on_any_texts(texts):
    e = packing.Encoder(PATH)
    for text in texts:
        assert e(text) == _plain(text)


def test_encoder_when_its_cache_turns(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_PARTS", 3)
    e = packing.Encoder(PATH)
    for text in ("one two, three four", "five (six) seven", "one five eight!", "two, nine", "one two, three four"):
        assert e(text) == _plain(text)


def test_first_bound_holds_enough_probed_anchors():
    rng = np.random.default_rng(1)
    anchors, q = rng.standard_normal((300, 8)), rng.standard_normal((40, 8))
    home = rng.integers(0, 10, 300)
    probed = np.stack([rng.permutation(10)[:6] for _ in range(40)])
    far = ann.first_bound(q, probed, anchors, home, 10, 12)
    for k in range(40):
        d = ((anchors[np.isin(home, probed[k])] - q[k]) ** 2).sum(1)
        assert (d <= far[k]).sum() == 12
    assert np.isinf(ann.first_bound(q, probed, anchors[:5], home[:5], 10, 12)).all()
    assert np.isinf(ann.first_bound(q, probed[:, :0], anchors, home, 10, 12)).all()


def test_one_hot_list_is_found(spark):
    """A third of all vectors equal: ties go to smaller ids and every query has its neighbours."""
    rng = np.random.default_rng(2)
    v = rng.standard_normal((300, 8))
    v[::3] = v[0]
    e = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = ann.search(e, ann.query_rows(e)).toPandas()
    assert got.groupby("query_id").size().tolist() == [20] * 15
    hit = 0
    for q, rows in got.groupby("query_id"):
        score = v @ v[q]
        score[q] = -np.inf
        assert np.allclose(rows.sort_values("rank")["score"], np.sort(rows["score"])[::-1])
        hit += (rows["score"] >= np.sort(score)[-20] - 1e-9).sum()
    assert hit / len(got) >= 0.9
