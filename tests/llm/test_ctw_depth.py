"""The context tree keeps its depth however many distinct grams the corpus has."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from ternion.llm import ctw

SCHEMA = "doc_id long, text string"


def test_depth_does_not_fall_with_the_corpus(spark):
    rng = random.Random(9)
    noise = ["".join(rng.choices("abcdefghijklmnopqrstuvwxy", k=105_000)) for _ in range(40)]  # over 4 million distinct grams
    train = [i for i in range(5000) if zlib.crc32(str(i).encode()) % 5 != 1]
    held = next(i for i in range(5000) if zlib.crc32(str(i).encode()) % 5 == 1)
    pairs = ["1zzzz1", "2zzzz2"]  # the last byte depends on the byte five before it
    rows = [(train[k], t) for k, t in enumerate([*noise, *pairs * 1500])] + [(held, "1zzzz1"), (held, "1zzzz2")]
    got = [(r.doc_id, r.score) for r in ctw.score(spark.createDataFrame(rows, SCHEMA).repartition(8)).collect()]
    right, wrong = sorted((s for i, s in got if i == held), reverse=True)
    assert len(got) == len(rows) and right - wrong > 2


def test_many_buckets_and_chunks_give_the_same(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choices("ab cdé", k=rng.randint(0, 60)))) for i in range(60)] + [(None, None), (7, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    take = lambda: sorted((r.doc_id or -1, round(r.score, 3), round(r.base_score, 6)) for r in ctw.score(docs).collect())
    want = take()
    monkeypatch.setattr(ctw, "BUCKET_BYTES", 40)
    monkeypatch.setattr(ctw, "CHUNK_BYTES", 300)
    assert take() == want


def test_base_and_code_length(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(["Aa", "aa", "bé", "c\u00a0d", "x"], k=rng.randint(0, 9)))) for i in range(80)] + [(None, None), (81, " \t"), (82, "new Words\nonly")]
    fold = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", fold(t)) + [None]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    count = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    for r in ctw.score(spark.createDataFrame(rows, SCHEMA)).collect():
        own = tokens(dict(rows)[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(own), sum(count[w] > 0 for w in own), n)
        assert abs(r.base_score - sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)) < 1e-9
        assert abs(r.bits_per_byte + r.score * math.log2(10) / (len((dict(rows)[r.doc_id] or "").encode()) + 1)) < 1e-9


def test_beats_the_word_base_where_words_depend_on_each_other(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(400)]
    after = [rng.choices(range(400), k=4) for _ in words]

    def text():
        at, out = rng.randrange(400), []
        for _ in range(200):
            out.append(words[at])
            at = rng.choice(after[at])
        return " ".join(out)

    rows = [(i, text()) for i in range(400)]
    got = [r for r in ctw.score(spark.createDataFrame(rows, SCHEMA)).collect() if r.held_out]
    assert len(got) > 50 and sum(r.score for r in got) > sum(r.base_score for r in got)


def test_packed_arrays():
    rng = np.random.default_rng(1)
    for n in (0, 1, 500):
        x = np.sort(rng.integers(0, 2**63, n).astype(np.uint64))
        y = rng.random(n).astype(np.float32)
        assert (ctw.expand(ctw.squeeze(x, True), np.uint64, True) == x).all() and (ctw.expand(ctw.squeeze(y), np.float32) == y).all()
