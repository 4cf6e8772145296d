"""Each stage of the corpus pipeline on its own input, against brute force, with awkward rows and columns."""

import random
from collections import Counter

import pytest

from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")

AWKWARD = ("_id", "_held", "_score", "_predicted", "_evidence", "_domain", "_lang", "_tokens", "_epochs", "_row", "domain", "toxic", "score", "at", "class_id", "digest", "a b", "x.y")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in AWKWARD)
WORDS = [a + b for a in "bdfgklmnprst" for b in ("a", "e", "ion", "or", "ütz")]


def rows():
    rng = random.Random(8)
    make = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    base = [make(rng.randint(20, 90)) for _ in range(60)]
    out = [(i, t + (" scum moron" if i % 6 == 0 else "")) for i, t in enumerate(base)]
    near = base[1].split()
    near[4] = "other"
    out += [(100, base[1]), (101, " ".join(near)), (1, base[2]), (1, base[2]), (None, base[3]), (None, None), (None, make(30)), (102, None), (103, ""), (104, ""), (105, "two words"), (105, "two other"), (106, make(60_000)), (107, 'password = "correct7horse!"')]
    return [(i, t, ("en", "de", None)[k % 3], f"src{k % 5}" if k % 7 else None, len(t) if t is not None else None, *["keep"] * len(AWKWARD)) for k, (i, t) in enumerate(out)]


@pytest.fixture(scope="module")
def place(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.parquet(f"{at}/documents.parquet")
    marks = [(i, 1, int(i % 6 == 0)) for i in range(60)] + [(None, 1, 1), (3, 1, None)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def pairs(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_toxicity(spark, place):
    docs = spark.read.parquet(f"{place}/documents.parquet")
    out = stage("toxicity")(spark, docs, place)
    assert out.columns == docs.columns and out.where(" AND ".join(f"`{c}` = 'keep'" for c in AWKWARD)).count() == out.count()
    assert pairs(out) == Counter((i, t) for i, t, *_ in rows() if not (t and "scum" in t))


def naive_classes(texts):
    """Numbers of equal classes by all pairs, for texts with their positions."""
    words = [t.split() if t is not None else None for t in texts]
    bags = [Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None for w in words]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(texts):
        for j in range(i):
            b = texts[j]
            both = bags[i] and bags[j]
            if (a is not None and a == b) or (both and sum((bags[i] & bags[j]).values()) >= 0.8 * sum((bags[i] | bags[j]).values())):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))]


def test_near_duplicates(spark, place):
    docs = spark.read.parquet(f"{place}/documents.parquet")
    out = stage("near_duplicates")(spark, docs, place)
    assert out.columns == docs.columns
    have = [(i, t) for i, t, *_ in rows()]
    best = {}
    for (i, t), c in zip(have, naive_classes([t for _, t in have]), strict=True):
        best[c] = min(best.get(c, (True, 0)), (i is None, i or 0))
    got = Counter(((r.doc_id is None, r.doc_id or 0), r.text) for r in out.collect())
    assert Counter(k for k, _ in got.elements()) == Counter(best.values())
    assert got[((False, 1), rows()[2][1])] == 0 or got[((False, 1), rows()[1][1])] == 1  # the repeated id keeps its own text
    assert not set(got) - {((i is None, i or 0), t) for i, t in have}


def test_secrets(spark, place):
    docs = spark.read.parquet(f"{place}/documents.parquet")
    out = stage("secrets")(spark, docs, place)
    assert out.columns == docs.columns and out.count() == docs.count()
    got = pairs(out)
    want = Counter((i, 'password = "[secret]"' if i == 107 else t) for i, t, *_ in rows())
    assert got == want
    assert out.where("text IS NOT NULL AND n_chars <> char_length(text)").isEmpty()


def test_mixing(spark, place):
    docs = spark.read.parquet(f"{place}/documents.parquet")
    out = stage("mixing")(spark, docs, place)
    assert out.columns == docs.columns and out.where("domain <> 'keep'").isEmpty()
    have, got = Counter((i, t) for i, t, *_ in rows()), pairs(out)
    assert not got - have
    tokens = lambda c: sum(len((t or "").split()) * n for (_, t), n in c.items())
    assert tokens(got) <= tokens(have) * corpus_pipeline.MIX_PERCENT // 100


def test_whole_run_and_empty_table(spark, place, tmp_path):
    pytest.importorskip("public_tokenizers")
    out = corpus_pipeline.run(spark, place)
    pieces = out.groupBy("doc_id").agg(F.count_if(F.expr("piece = 0")).alias("n")).collect()
    assert pieces and all(r.n == 1 for r in pieces if r.doc_id not in (None, 1, 105)) and not {r.doc_id for r in pieces} & {100}
    spark.read.parquet(f"{place}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{place}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
