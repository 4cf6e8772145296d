"""The corpus operators against brute force on small documents with nulls, empty texts, copies and clashing columns."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ternion.llm import ann, ctw, fingerprints, induced, minhash, mixing, packing, passages, secrets, sharding, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, id long"


def texts():
    rng = random.Random(5)
    words = [a + b for a in "bdfgklmnprst" for b in ("a", "e", "ion", "or", "ütz")]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = [make(rng.randint(20, 120)) for _ in range(30)]
    passage = make(30)
    out = [*base, base[0], base[0], "", "", None, None, "two words", "x" * 300]
    near = base[1].split()
    near[3] = "changed"
    out += [" ".join(near), base[2] + " " + passage + " " + base[3], passage]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 3 else "de", f"src{i % 5}", len(t) if t else 0, "k", 0) for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def test_near_duplicates(docs, none):
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    rows = {r.doc_id: r.text for r in docs.collect()}
    bags = {k: Counter(tuple(t.split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))) if t and t.split() else None for k, t in rows.items()}
    parent = {k: k for k in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in rows:
        for j in rows:
            if i < j and ((rows[i] is not None and rows[i] == rows[j]) or (bags[i] and bags[j] and sum((bags[i] & bags[j]).values()) >= 0.8 * sum((bags[i] | bags[j]).values()))):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    assert got == {k: find(k) for k in rows}
    assert minhash.near_duplicates(none).count() == 0


def test_near_duplicate_blocks_are_bounded_by_bytes_and_rows(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_BYTES", 20_000, raising=False)
    monkeypatch.setattr(minhash, "WIDE_BYTES", 50_000, raising=False)
    texts = spark.createDataFrame([(i, f"{i} " + "word " * 200, 1000 + len(f"{i} ")) for i in range(400)], "doc_id long, text string, bytes int")
    members = spark.createDataFrame([(0, 0, i) for i in range(400)], "key long, a long, id long")
    links = members.where("id BETWEEN 1 AND 99").select("a", F.col("id").alias("b"))
    rows = minhash._blocks(members, links, texts).cache()
    most = {r.side: r.b for r in rows.groupBy("g", "i", "j", "side").agg(F.sum(F.octet_length("text")).alias("b")).groupBy("side").agg(F.max("b").alias("b")).collect()}
    assert most[0] <= 100_000 and most[1] <= 50_000  # hashing deals about evenly
    met = {(a.id, b.id) for a, b in _sides(rows)}
    assert met == {(a, b) for a in range(400) for b in range(100, 400)}


def _sides(rows):
    at = {}
    for r in rows.collect():
        at.setdefault((r.g, r.i, r.j), ([], []))[r.side].append(r)
    return [(a, b) for own, other in at.values() for a in own for b in other]


def test_bags_do_not_depend_on_pieces(monkeypatch):
    t = pa.table({"id": [7, 8, 9, 10], "c": [7, 8, 8, 8], "text": ["a b c d e f a b c d e f", None, "", "one two"]})
    whole = minhash._bags(t)
    monkeypatch.setattr(minhash.tb.pieces, "__defaults__", ("text", 1))
    assert all((a == b).all() for a, b in zip(whole, minhash._bags(t), strict=True)) and whole[4].tolist() == [0, 6, 6, 6, 7]


def test_signatures_are_unbiased():
    rng = np.random.default_rng(1)
    sh = np.sort(rng.integers(0, 2**63, 60).astype(np.uint64))
    wa, wb = rng.integers(1, 9, 60), rng.integers(1, 9, 60)
    sig = minhash.signatures(np.r_[sh, sh], np.repeat([0, 1], 60), np.r_[wa, wb], 2, 4000)
    want = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 0.04


def test_passages(docs, none):
    rows = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    first = {}
    for i in sorted(rows):
        for p in range(len(rows[i]) - 49):
            first.setdefault(rows[i][p : p + 50], i)
    got = {r.doc_id: r for r in passages.remove_repeats(docs).collect()}
    for i, b in rows.items():
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < i:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = len([x for x in bytes(gone).split(b"\0") if x])
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    assert passages.remove_repeats(none).count() == 0


def test_suffix_order():
    rng = np.random.default_rng(2)
    for trial in range(60):
        limit, t = int(rng.choice([3, 8, 50])), rng.integers(0, 1 + trial % 4 + 1, rng.integers(1, 90)).astype(np.uint8)
        pos, lcp = induced.suffix_order(t, limit, memory=int(rng.choice([4, 10**6])))
        part = [t.tobytes()[i : i + limit] for i in pos]
        assert sorted(pos.tolist()) == list(range(len(t))) and part == sorted(part)
        for j in range(1, len(part)):
            same = next((k for k, (a, b) in enumerate(zip(part[j - 1], part[j], strict=False)) if a != b), min(len(part[j - 1]), len(part[j])))
            assert lcp[j] == same


def test_sharding(docs, none):
    got = sharding.minimax_shards(docs, shards=5, knots=4).toPandas()
    sizes = {r.doc_id: len((r.text or "").encode()) + 16 for r in docs.collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    groups = {}
    for i in sorted(text):
        groups[text[i]] = groups.get(text[i], 0) + sizes[i]

    def need(c):
        n, a = 1, 0
        for x in groups.values():
            if x > c:
                return 99
            n, a = (n + 1, x) if a + x > c else (n, a + x)
        return n

    best = next(c for c in range(1, sum(sizes.values()) + 1) if need(c) <= 5)
    assert got.groupby("shard")["size"].sum().max() == best
    assert (got.groupby("shard").slot.max() + 1 == got.groupby("shard").slot.count()).all() and not got.duplicated(["shard", "slot"]).any()
    assert got.assign(t=got.doc_id.map(text)).groupby("t", dropna=False).shard.nunique().max() == 1
    assert sharding.minimax_shards(none).count() == 0


def test_mixing(docs, none):
    got = mixing.mix(docs.withColumn("domain", mixing.domain_of_source()), share_percent=50).toPandas()
    total = sum(len(r.text.split()) for r in docs.collect() if r.text)
    assert 0 < (got.tokens * got.epochs).sum() <= total // 2 and got.epochs.max() <= 2
    whole = mixing.mix(docs.withColumn("domain", mixing.domain_of_source()), share_percent=100, max_epochs=1).toPandas()
    assert len(whole) == docs.count()
    assert mixing.mix(none.withColumn("domain", mixing.domain_of_source())).count() == 0


def test_fingerprints(docs, none):
    rows = sorted(docs.collect(), key=lambda r: -r.doc_id)
    got = {r.doc_id: r for r in fingerprints.edited_likeness(docs).collect()}
    for k, r in enumerate(rows):
        t, n = r.text or "", rows[(k + 1) % len(rows)].text or ""
        edited = t[: len(t) - len(t) // 3] + n[: len(t) // 3]
        g = got[r.doc_id]
        assert g.n_chars == len(t) and g.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and 0 <= g.near_edited <= 1 and 0 <= g.near_next <= 1
    assert got[0].fingerprint == got[30].fingerprint and fingerprints.edited_likeness(none).count() == 0


def test_secrets(spark, docs, none):
    forest = secrets.train(trees=12)
    held = secrets.labelled_findings(400, seed=77)
    p = forest.predict(np.array([secrets.features(*r[:4]) for r in held])) >= 0.5
    assert (p == np.array([r[4] == 1 for r in held])).mean() > 0.95
    key = "AKIA" + "Q7RWT2XZ9KLM4NPB"
    d = spark.createDataFrame([(1, f"see {key} or mail a.77@mail8.example.com, 10.20.30.40", "en", "s", 0, "k", 0), (2, None, None, None, None, None, None), (3, "", "", "", 0, "", 0)], SCHEMA)
    out = {r.doc_id: r.text for r in secrets.redact(d, forest).collect()}
    assert out == {1: "see [secret] or mail a.77@mail8.example.com, 10.20.30.40", 2: None, 3: ""}
    assert secrets.scan(none, forest).count() == 0


def test_ann(spark):
    rng = np.random.default_rng(3)
    v = rng.standard_normal((400, 16))
    rows = [(i, [float(x) for x in v[i]], 1) for i in range(400)] + [(400, None, 1), (401, [0.0] * 16, 1), (402, [float("nan")] * 16, 1), (403, [None] * 16, 1)]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>, list int")
    got = ann.search(e, ann.query_rows(e)).toPandas()
    hit = 0
    for q, g in got.groupby("query_id"):
        score = v @ v[q]
        score[q] = -np.inf
        hit += len(set(np.argsort(-score)[:20]) & set(g.vec_id))
        assert sorted(g["rank"]) == list(range(1, 21)) and np.allclose(g.score, score[g.vec_id])
    assert hit / len(got) >= 0.9 and got.query_id.nunique() == 20
    assert ann.search(e.limit(0), e.limit(0)).count() == 0


def test_toxicity(spark, none):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(40)) + (" scum idiot" if i % 8 == 0 else ""), "en", "s", 0, "k", 0) for i in range(400)]
    d = spark.createDataFrame([*rows, (400, None, None, None, None, None, None), (401, "", "", "", 0, "", 0)], SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i % 8 == 0)) for i in range(300)] + [(None, 0, 1), (301, 0, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score(d, toxicity.fit(d, labels)).collect()}
    assert all(got[i].predicted == int(i % 8 == 0) for i in range(400)) and got[400].predicted == 0 and got[401].predicted == 0
    assert len({round(r.score, 6) for r in got.values()}) > 50
    assert toxicity.score(none, toxicity.fit(none, labels.limit(0))).count() == 0


def naive_ctw(train, texts, depth):
    """Context-tree weighting by recursion over explicit nodes, counts fixed after training."""
    from math import exp, lgamma, log, pi

    nodes = Counter()

    def steps(text):
        data = [0] * depth + list(text) + [0]
        for i in range(depth, len(data)):
            yield tuple(data[i - depth : i]), data[i]

    for t in train:
        for ctx, x in steps(t):
            for level in range(8):
                for d in range(depth + 1):
                    nodes[ctx[depth - d :], (1 << level) | (x >> (8 - level)), (x >> (7 - level)) & 1] += 1
    seen = {(c, p) for c, p, _ in nodes}
    children = {}
    for c, p in seen:
        if c:
            children.setdefault((c[1:], p), []).append((c, p))

    def pe(k):
        a, b = nodes[(*k, 0)], nodes[(*k, 1)]
        return lgamma(a + 0.5) + lgamma(b + 0.5) - lgamma(a + b + 1) - log(pi)

    memo = {}

    def pw(k):
        if k not in memo:
            e = pe(k)
            if len(k[0]) == depth:
                memo[k] = e
            else:
                s = sum(pw(c) for c in children.get(k, []))
                hi, lo = max(e, s), min(e, s)
                memo[k] = log(0.5) + hi + log(1 + exp(lo - hi))
        return memo[k]

    def prob(ctx, p, bit, d=0):
        k = (ctx[depth - d :], p)
        a, b = nodes[(*k, 0)], nodes[(*k, 1)]
        kt = ((b if bit else a) + 0.5) / (a + b + 1)
        if d == depth:
            return kt
        w = exp(log(0.5) + pe(k) - pw(k))
        return w * kt + (1 - w) * prob(ctx, p, bit, d + 1)

    return [sum(log(prob(c, (1 << v) | (x >> (8 - v)), (x >> (7 - v)) & 1)) for c, x in steps(t) for v in range(8)) / log(10) for t in texts]


def test_ctw(spark, none):
    rows = [(i, t, "en", "s", 0, "k", 0) for i, t in enumerate(["abracadabra cad", "Bar abra", None, "", "cadabra", "zap é", "abra abra abra", "rab"])]
    d = spark.createDataFrame(rows, SCHEMA)
    fold = lambda t: bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode())
    train = [fold(t) for i, t, *_ in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    want = naive_ctw(train, [fold(t) for _, t, *_ in rows], 3)
    got = {r.doc_id: r.score for r in ctw.score(d, depth=3).collect()}
    assert all(abs(got[i] - want[i]) < 1e-3 for i in got) and len(got) == len(rows)
    assert ctw.score(none).count() == 0


def test_packing(docs, none):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("word_bpe_49k.json")
    got = packing.pack(docs, path, capacity=64).toPandas()
    tok = Tokenizer.from_file(path)
    for r in docs.collect():
        ids = np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        own = got[got.doc_id == r.doc_id].sort_values("piece")
        assert own.ids_crc32.tolist() == [zlib.crc32(ids[a : a + 64].tobytes()) for a in range(0, len(ids), 64)] and own.length.sum() == len(ids)
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() <= 64
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 64) + 2 and packing.pack(none, path).count() == 0


def test_plan_rounds_exactly():
    rng = random.Random(4)
    h = Counter(rng.randint(1, 100) for _ in range(3000))
    plan = packing.plan(dict(h), 100)
    used = Counter()
    for sizes, n in plan:
        assert sum(sizes) <= 100
        for s in sizes:
            used[s] += n
    assert used == h and sum(n for _, n in plan) <= 1.01 * sum(n for _, n in packing._best_fit(dict(h), 100, [])) + 1
