"""Steps whose cost must follow the input: what is compared once, what goes to the rows and not they to it."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ternion.functions import text as T
from ternion.functions.parsing import matching_ratio
from ternion.operators import graph as G
from ternion.schema import SCHEMA_CATALOG


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_labels_of_one_form_are_compared_once(spark):
    """Labels that differ in characters no entry has share a form; results are those of every pair compared."""
    rnd = random.Random(5)
    entries = [(i, "classes", x, f"i{i}") for i, x in enumerate(["Order Line", "Penalty Fare", "opérateur 1", "Service", "service "])]
    catalog = spark.createDataFrame(entries, SCHEMA_CATALOG)
    labels = [f"Order  Lin {k}" for k in range(40)] + ["", "Service", "SERVICES 😀", "opérateur 1", None, "\ue000", "z"]
    labels += ["".join(rnd.choices("abcdeorlinspv 17#é", k=rnd.randint(1, 14))) for _ in range(200)]
    norm = lambda x: " ".join(x.split()).lower()
    for least in (0.0, 0.6):
        expected = {}
        for x in {x for x in labels if x is not None}:
            score, at = max((matching_ratio(norm(x), norm(e[2])), -e[0]) for e in entries)
            if score > 0 and score >= least:
                expected[x] = (f"i{-at}", score)
        got = G.best_match(spark.createDataFrame([(x,) for x in labels], "label string"), catalog, "classes", least).collect()
        assert {r["label"]: (r["iri"], r["score"]) for r in got} == expected and len(got) == len(expected)
    form = G._form(catalog.select(T.label_norm(F.col("label")).alias("norm")))
    assert spark.createDataFrame([(f"order 2{k}",) for k in (23, 45, 67)], "x string").select(form(F.col("x"))).distinct().count() == 1


@pytest.fixture
def mapped(spark):
    t = spark.createDataFrame([(k, f"s {k}", ("likes", "Likes", None)[k % 3], f"s {k + 1}" if k % 2 else str(k), "x") for k in range(30)], "seq long, subject string, predicate string, object string, provenance_sentence string")
    names = spark.createDataFrame([("likes", "object_property", "loves", "")], "name string, kind string, label string, comment string")
    return t, names, G.schema_catalog(spark)


def test_what_is_known_of_predicates_goes_to_the_triplets(mapped):
    """No triplet is dealt by its predicate, of which there are few; triplets without one stay."""
    t, names, catalog = mapped
    edges = G.map_edges(t, G.map_nodes(t, names, catalog), names, catalog)
    joins = [x for x in _plan(edges).splitlines() if "Join" in x and "[predicate" in x]
    assert joins and all("BroadcastHashJoin" in x for x in joins)
    assert sorted((r["seq"], r["predicate_label"]) for r in edges.collect()) == [(k, ("loves", "Likes", None)[k % 3]) for k in range(30)]


def test_literals_and_slugs(spark):
    """Cheaper forms of T8 and T13 decide as before."""
    rows = [(" 12 \n", True, "12"), ("\u00a0-3.5\u2003", True, "3_5"), ("3.", False, "3"), ("May 2020", True, "May_2020"), ("no date", False, "no_date"), ("the 1990s ", True, "the_1990s"), ("1-URGENT", False, "1_URGENT"), (" __ ", False, "item"), ("", False, "item"), ("a\n", False, "a")]
    got = spark.createDataFrame(rows, "x string, l boolean, s string").select("l", T.is_literal(F.col("x")), "s", T.slug(F.col("x"))).collect()
    assert all(r[0] == r[1] and r[2] == r[3] for r in got)


def test_functional_properties_go_to_the_triples(spark):
    """no task gets all triples of a property."""
    g = spark.createDataFrame([(f"s{k}", "p", f"o{k % 3}") for k in range(6)] + [("s0", "p", "x")], "s string, p string, o string")
    found = G.functional_violations(g, spark.createDataFrame([("p",), ("q",)], "p string"))
    assert "SortMergeJoin" not in _plan(found) and "BroadcastHashJoin" in _plan(found)
    assert [tuple(r) for r in found.collect()] == [("s0", "p", 2)]


def test_blocks_are_multiplied_in_strips():
    """a task holds a strip of the product of two blocks, not all of it."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from ternion.operators import linking as L

    v = np.random.default_rng(1).normal(size=(4096, 4))
    t = pa.table({"name": [f"{i:05d}" for i in range(4096)], "vec": pa.array(v.tolist(), pa.list_(pa.float64()))})
    tracemalloc.start()
    got = L._meet(t, t, None, 3, False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.num_rows == 3 * 4096 and peak < 100 * 2**20
    u = v / np.linalg.norm(v, axis=1)[:, None]
    score = u @ u.T
    np.fill_diagonal(score, -2)
    assert np.allclose(np.array(got["score"]).reshape(-1, 3), -np.sort(-score, axis=1)[:, :3])


def test_pairs_are_compared_once(spark, monkeypatch):
    """two blocks meet once; pairs are those of both directions, equal names and uneven vectors included."""
    import numpy as np

    from ternion.operators import linking as L

    monkeypatch.setattr(L, "BLOCK", 16)
    rnd = np.random.default_rng(2)
    rows = [(f"n{i % 45}", [float(x) for x in rnd.normal(size=3 if i % 7 else 2)]) for i in range(60)] + [("z", []), ("y", None), ("w", [0.0, 0.0, 0.0])]
    items = spark.createDataFrame(rows, "name string, vec array<double>")
    pair = lambda df: sorted((min(r["a"], r["b"]), max(r["a"], r["b"]), round(r["score"], 9)) for r in df.collect())
    for least in (0.5, 0.0):
        once, both = pair(L.similar_pairs(items, least)), pair(L.similar(items, items, least=least))
        assert once == both[::2] == both[1::2] and once


def test_axioms_go_to_the_facts(spark):
    """facts are not dealt by predicate or class, which are few."""
    from ternion.schema import OWL, RDF_TYPE, RDFS

    rows = [("a", "p", "b"), ("c", "p", "d"), ("p", RDFS + "subPropertyOf", "q"), ("q", OWL + "inverseOf", "r"), ("p", RDFS + "domain", "C"), ("C", RDFS + "subClassOf", "D"), ("s", RDF_TYPE, OWL + "SymmetricProperty")]
    found = G.owl_closure(spark.createDataFrame([(*r, "iri", "", "") for r in rows], "s string, p string, o string, o_kind string, datatype string, lang string"))
    assert "BroadcastHashJoin" in _plan(found) and "SortMergeJoin" not in _plan(found)
    got = {(r["s"], r["p"], r["o"]) for r in found.collect()}
    assert got - set(rows) == {(x, "q", y) for x, y in ("ab", "cd")} | {(y, "r", x) for x, y in ("ab", "cd")} | {(x, RDF_TYPE, c) for x in "ac" for c in "CD"}


def test_parts_of_reasoning_follow_the_rows(spark, monkeypatch):
    """what meets in a task is bounded, and literals are not dealt."""
    from ternion.schema import PT, TRIPLES

    monkeypatch.setattr(G, "TASK_TRIPLES", 10, raising=False)
    rows = [(f"a{k}", PT + "operates", f"b{k}", False, "") for k in range(500)] + [("b0", PT + "operatedBy", "a0", False, "")]
    found = G.reason(spark.createDataFrame(rows, TRIPLES))
    assert ", 51)" in _plan(found)
    assert found.count() == 501 + 499


def test_preprocessing_without_rewriting_cuts_no_chunks(spark):
    """the sentences are joined at once, as the chunks would be."""
    texts = [(x,) for x in ("One two. Three four! Five", "a.  B c.\n\nD", " ", "", None, "word " * 30 + ". Next. X")]
    df = spark.createDataFrame(texts, "text string").select("text", T.preprocess(F.col("text"), 3).alias("plain"), T.preprocess(F.col("text"), 3, lambda x: x).alias("cut"))
    assert "aggregate(" not in _plan(df.select("plain"))
    rows = df.collect()
    assert [r["plain"] for r in rows] == [r["cut"] for r in rows] and rows[2]["plain"] == " " and rows[1]["plain"] == "a. B c. D"


def test_few_solutions_go_to_the_triples(spark, tmp_path):
    """where a filter fixes a term, no pattern's triples are dealt for a join."""
    from ternion.plans import workload
    from ternion.plans.sparql import Engine

    parts = workload.network(spark, "/root/testdata/sf0.001")
    found = Engine(parts=parts).query(workload._P + workload.SPARQL["sparql_q4_adjacent_stops"][0])
    assert "SortMergeJoin" not in _plan(found) and "ShuffledHashJoin" not in _plan(found)
