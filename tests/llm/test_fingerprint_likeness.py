"""Likeness of fingerprints against the shingle sets of the whole texts."""

import random
import re

from pyspark.sql import functions as F

from ternion.llm import fingerprints

WORDS = [a + b for a in "bdfgklmnprst" for b in ("a", "e", "ion", "or", "ütz")]


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return 1.0 if a == b else len(shingles(a) & shingles(b)) / max(1, len(shingles(a) | shingles(b)))


def rows():
    rng = random.Random(11)
    texts = [" ".join(rng.choice(WORDS) for _ in range(n)) for n in (3, 5, 6, 40, 90, 300, 300, 2000)]
    texts += [texts[4], texts[5] + " and more", "", None, " \t ", "one", texts[7][:6000]]
    return [(i, t) for i, t in enumerate(texts)] + [(None, "no number"), (3, texts[3])]


def test_every_hash_kept_is_the_jaccard_of_the_sets(spark):
    have = {i: t or "" for i, t in rows()}
    order = sorted(((i, t or "") for i, t in set(rows())), key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = {r.doc_id: r for r in fingerprints.edited_likeness(spark.createDataFrame(rows(), "doc_id long, text string"), scale=1).collect()}
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        assert abs(got[i].near_edited - jaccard(text, edited)) < 1e-12, i
        assert abs(got[i].near_next - jaccard(text, after)) < 1e-12, i
    assert set(got) == set(have)


def test_a_sketch_is_what_lies_below_the_threshold(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string")
    full = {(r.doc_id, r.n_chars): set(r.sketch) for r in fingerprints.fingerprints(docs, scale=1).collect()}
    some = {(r.doc_id, r.n_chars): r.sketch for r in fingerprints.fingerprints(docs).collect()}
    limit = -(2**63) + 2**64 // fingerprints.SCALE
    assert all(some[k] == sorted(x for x in full[k] if x < limit) for k in full)


def test_estimates_of_long_texts(spark):
    """Containment and merging hold for the sketch of a long text and of its half."""
    rng = random.Random(5)
    whole = " ".join(rng.choice(WORDS) + str(i) for i in range(8000))
    half = " ".join(whole.split()[:4000])
    pair = spark.createDataFrame([(whole, half)], "w string, h string").select(fingerprints.sketch(F.col("w")).alias("w"), fingerprints.sketch(F.col("h")).alias("h"))
    got = pair.select(fingerprints.containment(F.col("h"), F.col("w")).alias("c"), fingerprints.containment(F.col("w"), F.col("h")).alias("d"), (fingerprints.merge(F.col("w"), F.col("h")) == F.col("w")).alias("m")).first()
    assert got.c == 1.0 and abs(got.d - 0.5) < 0.06 and got.m
