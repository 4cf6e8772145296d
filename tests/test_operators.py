"""Text functions and graph operators on small inputs with known answers."""

import pytest
from pyspark.sql import functions as F

from ternion.functions import parsing
from ternion.functions import text as T
from ternion.operators import components
from ternion.operators import graph as G
from ternion.operators import linking as L
from ternion.operators.closure import transitive_closure
from ternion.operators.components import connected_components
from ternion.plans.lineage import cut
from ternion.schema import PT, RDF_TYPE, TRIPLES
from ternion.sources.structured import json_triplets_of, tsv_triplets


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "t string").select(f(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    ("text", "want"), [("42", True), (" 3.5 ", True), ("8 August 1898", True), ("Act 1990s", True), ("late-1900s", True), ("Route 73", False), ("1/8/1898", True)]
)
def test_literals(spark, text, want):
    assert one(spark, text, T.is_literal) is want


def test_text_functions(spark):
    assert one(spark, "One.  Two! three?\nFour", T.sentences) == ["One.", "Two!", "three?", "Four"]
    assert one(spark, "One.  Two! three?\nFour", lambda c: T.sentences(c, True)) == ["One.", "Two! three?", "Four"]
    assert one(spark, "café l'eau_1", T.tokens) == ["café", "l", "eau_1"]
    assert one(spark, "a b. c d e. f.", lambda c: T.greedy_chunks(T.sentences(c), 4)) == ["a b.", "c d e. f."]
    assert one(spark, "The Red  Lines!", T.surface_norm) == "red line"
    assert one(spark, "glass", T.surface_norm) == "glass"
    assert one(spark, "--", T.slug) == "item" and one(spark, " a b/c ", T.slug) == "a_b_c"
    assert one(spark, "isTflService", T.camel_label) == "is tfl service"
    assert one(spark, "http://x.org/a#Bus_Stop", T.local_name) == "Bus Stop"
    assert one(spark, "Bus at King Cross and Bus", T.mentions) == ["Bus", "King Cross"]
    assert one(spark, "zone 12 of 3", T.first_integer) == 12 and one(spark, "none", T.first_integer) is None


@pytest.mark.parametrize(
    ("text", "want"),
    [("<triplet> TfL <subj> London Underground <obj> operator", [("TfL", "operator", "London Underground")]), ("<triplet> TfL <subj> x", []), ("", []), ("plain text", []),
     ("<triplet> A <subj> B <obj> p <subj> C <obj> q", [("A", "p q", "B C")]), ("<triplet> A <subj>B <obj> p", []),
     ("<s><triplet> A <subj> B <obj> p <triplet> C <subj> D <obj> q</s>", [("A", "p", "B"), ("C", "q", "D")])],
)
def test_linearised(spark, text, want):
    assert [tuple(x) for x in one(spark, text, T.linearised_triplets)] == want


def test_tolerant_parsing():
    assert parsing.tolerant_json('noise {"a": [1, 2]} tail') == {"a": [1, 2]}
    assert parsing.tolerant_json('{"a": [1, 2') == {"a": [1, 2]} or parsing.tolerant_json('{"a": [1, 2]') == {"a": [1, 2]}
    assert parsing.agent_json("x") is None and parsing.agent_json('say {"k": 1}') == {"k": 1}
    text = "Anna came. She sat."
    assert parsing.replace_spans(text, parsing.chain_spans(text, [[(0, 4), (11, 14)]])) == "Anna came. Anna sat."


def test_structured(spark):
    data = {"name": "Red", "lineColor": "r", "open": True, "stops": ["A", {"name": "B", "zone": 2}], "skip": None}
    assert list(json_triplets_of(data)) == [("Red", "line color", "r"), ("Red", "open", "True"), ("Red", "stops", "A"), ("Red", "stops", "B"), ("B", "zone", "2")]
    assert list(json_triplets_of({"lines": [{"name": "x", "a": 1}]})) == []
    nested = {"name": "N", "a": {"stationName": "S", "zone": 1}, "b": [{"naptanId": "X", "zone": 2}, {"stationName": "T", "zone": 3}]}
    assert list(json_triplets_of(nested)) == [("S", "zone", "1"), ("N", "b", "X"), ("X", "zone", "2"), ("T", "zone", "3")]
    text = '0\nmodeName\t"bus"\nisTflService\t"true"\tx\n1\nfoo\tbar\n2\tU\nline\t{ id: "L7" }\nzone\t4\n'
    got = tsv_triplets(spark.createDataFrame([("d", text)], "doc_id string, text string")).collect()
    assert [(r.subject, r.predicate, r.object) for r in got] == [("bus", "is tfl service", "true"), ("L7", "2", "U"), ("L7", "zone", "4")]


def test_components_and_closure(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (4, 5), (7, 7), (None, 1)], "src long, dst long")
    assert {(r.node, r.component) for r in connected_components(e).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (7, 7)}
    assert {tuple(r) for r in transitive_closure(e).collect()} == {(1, 2), (2, 3), (1, 3), (5, 4), (4, 5), (4, 4), (5, 5), (7, 7)}
    assert connected_components(e.limit(0)).count() == 0 and transitive_closure(e.limit(0)).count() == 0


def test_few_edges_cost_few_jobs_and_the_same_components(spark, monkeypatch):
    chain = [(i, i + 1) for i in range(0, 90) if i % 30] + [(80, 3), (40, 40), (200, 200), (None, 1), (2, 1)]
    long = spark.createDataFrame(chain, "src long, dst long")
    text = long.select(*[F.concat(F.lit("é"), F.col(c).cast("string")).alias(c) for c in ("src", "dst")])
    written = []
    monkeypatch.setattr(components, "cut", lambda df, name="cut": written.append(name) or cut(df, name))
    few = [sorted(map(tuple, connected_components(x).collect())) for x in (long, text)]
    assert len(written) == 4
    monkeypatch.setattr(components, "FEW", 0)
    assert few == [sorted(map(tuple, connected_components(x).collect())) for x in (long, text)]
    assert {c for _, c in few[0]} == {1, 31, 200} and len(few[0]) == 91


def test_linking(spark):
    items = spark.createDataFrame([("Red Line", True, [1.0, 0.0]), ("red lines", True, [0.9, 0.1]), ("Bus", False, [0.0, 1.0])], "name string, is_new boolean, vec array<double>")
    assert {(r.name, r.rep) for r in L.surface_groups(items).collect()} == {("Red Line", "Red Line"), ("red lines", "Red Line"), ("Bus", "Bus")}
    d = L.decide(L.candidate_pairs(items))
    c = L.clusters(items, d)
    names = {r.name: r.canonical for r in L.canonical_names(c, spark.createDataFrame([("red lines",)], "name string")).collect()}
    assert names == {"Red Line": "red lines", "red lines": "red lines", "Bus": "Bus"}
    assert L.conflicts(c, d).count() == 0


def test_rules_and_validation(spark):
    t = spark.createDataFrame([(PT + "a", PT + "operates", PT + "b", False, ""), (PT + "a", PT + "label", "x", True, "")], TRIPLES)
    got = {(r.s, r.p, r.o) for r in G.reason(t).collect()}
    assert got == {(PT + "a", RDF_TYPE, PT + "ConnectedEntity"), (PT + "b", PT + "operatedBy", PT + "a")}
    assert not G.validate(t)["failed"]
    assert G.validate(t.limit(0))["errors"] == ["Ontology contains no triples.", "No object/data relations found."]
    bad = G.validate(spark.createDataFrame([("TfL", "p", "o", False, "")], TRIPLES), conflicts=3)
    assert bad["failed"] and bad["reroute_target"] == "entity_linking" and "conflict" in bad["errors"][-1]
    assert G.route(2, True, "extraction") == "end" and G.route(0, True, "schema_mapping") == "schema_mapping" and G.route(0, True) == "entity_linking" and G.route(0, False, "end") == "end"


def test_mapping_and_construction(spark):
    t = spark.createDataFrame([(1, "TfL", "operates", "Central line", "TfL operates it."), (2, "Route 73", "stops", "42", "")], "seq long, subject string, predicate string, object string, provenance_sentence string")
    names = spark.createDataFrame([], "name string, kind string, label string, comment string")
    cat = G.schema_catalog(spark)
    nodes = G.map_nodes(t, names, cat)
    edges = G.map_edges(t, nodes, names, cat)
    assert {r.name for r in nodes.collect()} == {"TfL", "Central line", "Route 73"}
    assert {r.name: r.id for r in nodes.collect()} == {"Central line": "ent_1", "Route 73": "ent_2", "TfL": "ent_3"}
    known = spark.createDataFrame([("Route 73", "class", "The 73", ""), ("stops", "datatype_property", "Stops At", "")], "name string, kind string, label string, comment string")
    learned = G.schema_catalog(spark, spark.createDataFrame([(1, "classes", " route  73", "urn:r")], "ord long, role string, label string, iri string"))
    shut, open_ = G.map_nodes(t, known, cat), G.map_nodes(t, known, learned)
    assert {r.name: r.id for r in shut.collect()} == {"Central line": "ent_1", "TfL": "ent_3"} and {r.name for r in G.map_nodes(t, known, cat, demote=True).collect()} == {"Central line", "Route 73", "TfL"}
    mapped = {r.name: (r.label, r.class_iri, r.is_class) for r in open_.collect()}
    assert mapped["Route 73"] == ("The 73", "http://example.org/tfl#Route_73", True)
    stop = G.map_edges(t, open_, known, learned).where("seq = 2").first()
    assert (stop.predicate_label, stop.predicate_iri, stop.predicate_kind, stop.mapped) == ("Stops At", "http://example.org/tfl#stops", "datatype_property", False)
    assert G.construct(nodes, edges.where("seq = 1")).where("s LIKE '%stmt/%'").first().s.endswith("stmt/1")
    e = {r.seq: r for r in edges.collect()}
    assert e[1].object_id and e[1].predicate_iri.endswith("#operates") and e[2].object_literal == "42" and e[2].object_datatype.endswith("integer")
    triples = G.construct(nodes, edges)
    assert not G.validate(triples)["failed"] and G.to_graph(triples).count() == triples.distinct().count()


def test_ranks_and_blocks(spark):
    from ternion.plans.lineage import ranked

    rows = spark.createDataFrame([(x,) for x in ["b", "a", "c", None, "a"]], "x string").repartition(3)
    assert [(r.x, r["rank"]) for r in ranked(rows, "x").orderBy("rank").collect()] == [(None, 1), ("a", 2), ("a", 3), ("b", 4), ("c", 5)]
    vectors = spark.createDataFrame([("p", [1.0, 0.0]), ("q", [1.0, 0.1]), ("r", [0.0, 0.0]), ("s", [1.0]), ("t", None)], "name string, vec array<double>")
    got = {(r.a, r.b): round(r.score, 3) for r in L.similar(vectors, vectors).collect()}
    assert got[("p", "q")] == 0.995 and got[("p", "r")] == got[("p", "s")] == got[("p", "t")] == 0 and len(got) == 20
    near = {(r.name, r["rank"]): r.near for r in L.knn(vectors, vectors.withColumn("kind", F.lit("k")), 2).collect()}
    assert near[("p", 1)] == "q" and near[("p", 2)] == "t" and near[("r", 1)] == "t"


def test_common_tokens_meet_in_parts(spark, monkeypatch):
    rows = [(f"line {i} {w}", i % 2 == 0, [float(i % 3), 1.0]) for i, w in enumerate(["red", "blue", "red", "green", "blue", "red", "old"])]
    items = spark.createDataFrame(rows, "name string, is_new boolean, vec array<double>")
    want = {(r.a, r.b) for r in L.blocked_pairs(items).collect()}
    monkeypatch.setattr(L, "TOKEN_NAMES", 2)
    assert want and {(r.a, r.b) for r in L.blocked_pairs(items).collect()} == want


def test_union_find_needs_few_rounds(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "src long, dst long")
    assert transitive_closure(chain).count() == 40 * 41 // 2
