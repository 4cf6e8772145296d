"""The chain from documents to a graph, its state, providers and their failures, ontology files, completion, evaluation."""

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from ternion.operators import providers as P
from ternion.plans import documents as D
from ternion.plans import tbox
from ternion.plans.sparql import Engine
from ternion.schema import GRAPH, OWL, PT, RDF_TYPE, RDFS, TFL
from ternion.sources import sinks
from ternion.sources.graphs import read_graph
from ternion.sources.rdfxml import parse_graph, parse_rdfxml

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import this module

TEXT = "Central Line serves Oxford Circus Station. It crosses Victoria Line near Bond Street. The Victoria Line is operated by Transport For London."


class Failing:
    """Fails on some tasks, answers the others by rule; now and then too little."""

    def __init__(self, tasks, short=()):
        self.tasks, self.short = tasks, short

    def answer(self, task, payloads):
        if task in self.tasks:
            raise RuntimeError("no model")
        got = P.LocalProvider().answer(task, payloads)
        return got[:1] if task in self.short else got


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(TEXT)
    (tmp_path / "in" / "b.txt").write_text("Victoria Line crosses Jubilee Line. Bakerloo Line opened 1906.")
    (tmp_path / "in" / "c.json").write_text('{"name": "Red Line", "zone": 2, "stops": ["Alpha Station"]}')
    return tmp_path


def test_batch_run_and_replay(spark, folder):
    out = f"{folder}/out"
    first = D.run_folder(spark, f"{folder}/in", out, structured=True)
    assert first["sources_processed"] == 3 and first["cache_hits"] == 0 and first["final_triples"] > 20
    assert {"extraction", "entity_linking", "validation"} <= set(first["cumulative_timings"])
    graph = read_graph(spark, f"{out}/final/part-*")
    assert graph.count() == first["final_triples"]
    have = {(r.s, r.p, r.o) for r in graph.collect()}
    assert (TFL + "Red_Line", TFL + "zone", "2") in have and (TFL + "The_Victoria_Line", RDF_TYPE, PT + "ConnectedEntity") in have
    again = D.run_folder(spark, f"{folder}/in", out, structured=True)
    assert again["cache_hits"] == 3 and again["runs"] == [] and again["final_triples"] == first["final_triples"]
    assert sinks.load_json(spark, f"{out}/run_summary.json", None)["cache_hits"] == 3
    assert any(e["label"] == "TransportEntity" for e in sinks.load_json(spark, f"{out}/rag_catalog.json", {})["classes"])


def test_sequential_run_keeps_names(spark, folder):
    out = f"{folder}/out"
    D.run_folder(spark, f"{folder}/in", out, patterns="a.txt,b.txt", mode="sequential")
    state = D.State.load(spark, out)
    assert state.triples.select("path").distinct().count() == 2 and state.hashes.count() == 2
    names = {r.surface: r.canonical for r in state.canonical.where("category = 'entities_individual'").collect()}
    assert names["The Victoria Line"] == "The Victoria Line" and "Jubilee Line" in names
    (folder / "in" / "b.txt").write_text("Jubilee Line meets Victoria Line.")
    assert D.run_folder(spark, f"{folder}/in", out, patterns="a.txt,b.txt", mode="sequential")["cache_hits"] == 1
    state = D.State.load(spark, out)
    assert not state.triples.where(f"o = '{TFL}Bakerloo_Line' OR s = '{TFL}Bakerloo_Line'").count()


def test_failures_have_their_outcome(spark):
    docs = spark.createDataFrame([("d", TEXT)], "doc_id string, text string")
    every = D.extract(docs, P.LocalProvider()).count()
    assert every > D.extract(docs, Failing({"relations"})).count() > 0
    assert D.extract(docs, Failing({"relations", "ner", "extract", "coref"})).count() == 0
    names = spark.createDataFrame([("entities", "A"), ("entities", "B")], "base_category string, name string")
    got = {r.name: (r.description, r.vec) for r in P.embedded(P.described(names, Failing({"describe", "embed"})), Failing({"embed"})).collect()}
    assert got == {"A": ("A", []), "B": ("B", [])}
    short = P.described(names.coalesce(1), Failing(set(), {"describe"}))
    assert {r.description for r in short.collect()} == {"A", "B"}
    shown = names.select("*", F.array().cast("array<string>").alias("usage"), F.array().cast("array<string>").alias("near"), F.lit(False).alias("has_literal"))
    assert {r.kind for r in P.classified(shown, Failing({"classify_entity"})).collect()} == {None}
    members = spark.createDataFrame([("long name", "c", False, True), ("name", "c", False, True), ("known", "k", True, False), ("zz", "k", False, True)], "name string, cluster string, known boolean, is_new boolean")
    assert [r.same for r in P.judged(members, Failing({"same"}), "class").collect()] == [True, True]
    assert {r.name: r.canonical for r in P.named(members, Failing({"canonical"})).collect()} == {"long name": "name", "name": "name", "known": "known", "zz": "known"}


def test_transport_asks_again_on_bad_json():
    seeds = []

    class Server(P.HttpProvider):
        def stream(self, body):
            seeds.append(body["options"]["seed"])
            return "nothing" if len(seeds) < 3 else '{"description": "x"'

    assert Server("http://none", "m", {"describe": "p"}).answer("describe", [{"name": "A"}]) == [{"description": "x"}] and seeds == [42, 43, 44]
    seeds.clear()
    with pytest.raises(ValueError):
        Server("http://none", "m", {"describe": "p"}, tries=2).answer("describe", [{}])


def test_agent_turns():
    said = iter(['{"tool": "sparql_query", "query": "q"}', 'so {"answer": "42"}'])
    got = P.agent("?", lambda prompt: next(said), lambda name, p: [{"row": str(i)} for i in range(30)], "s")
    assert got["answer"] == "42" and len(got["turns"]) == 2
    assert P.agent("?", lambda p: "hm", None, "s") == {"answer": None, "turns": [{"turn": 1, "raw": "hm", "error": "unparseable"}]}
    assert P.agent("?", lambda p: '{"tool": "t"}', lambda *a: [], "s")["answer"] is None


def test_ontology_ingest_and_questions(spark, tmp_path):
    graph = tbox.tbox(spark, reasoning=True)
    assert graph.where(f"o = '{OWL}Class'").count() == 21 and tbox.disjoint_pairs(spark).count() == 28
    (tmp_path / "owl").mkdir()
    from ternion.sources.turtle import to_turtle, turtle_header

    (tmp_path / "owl" / "base.ttl").write_text(turtle_header() + "\n".join(r.value for r in to_turtle(graph).collect()))
    out = f"{tmp_path}/out"
    got = D.ingest_ontology(spark, f"{tmp_path}/owl", out)
    assert got["files"] == 1 and got["classes"] == 21 and got["predicates"] == 23 and D.ingest_ontology(spark, f"{tmp_path}/owl", out)["files"] == 0
    state = D.State.load(spark, out)
    note = state.embeddings.where("name = 'Zone'").first()
    assert note.description == "Zone" and len(note.vec) == P.DIMENSIONS
    assert state.canonical.where("category = 'entities_class' AND surface = 'Zone' AND canonical = 'Zone'").count() == 1
    engine = Engine(graph)
    said = iter([json.dumps({"tool": "sparql_query", "query": f"SELECT ?c WHERE {{ ?c rdfs:subClassOf <{TFL}Fare> }}"}), '{"answer": "two"}', "?"])
    records = D.answer_questions(engine, [{"id": 1, "question": "which?", "expected": "two"}, {"id": 2, "question": "what?"}], lambda p: next(said), f"{out}/eval.json")
    assert records["answered"] == 1 and len(sinks.load_json(spark, f"{out}/eval.json", [])) == 2
    corpus = f"# ====\n# Q1: fares?\n# ====\nSELECT ?c WHERE {{ ?c rdfs:subClassOf <{TFL}Fare> }}\n\n# ====\n# Q2: bad?\n# ====\nSELECT nonsense\n"
    report = D.evaluate(engine, corpus, f"{out}/report.md")
    assert "| Q1: fares? | 2 |" in report and "| Q2: bad? | Error" in report and sinks.read_text(spark, f"{out}/report.md") == report


def test_completion(spark, tmp_path):
    rows = [(TFL + "A", RDF_TYPE, TFL + "Station", "iri", "", ""), (TFL + "A", RDFS + "label", "Alpha", "literal", "", ""), (TFL + "B", RDF_TYPE, TFL + "Station", "iri", "", ""), (TFL + "B", RDFS + "label", "Beta", "literal", "", ""), (TFL + "B", TFL + "locatedInZone", TFL + "Zone_1", "iri", "", "")]
    graph = spark.createDataFrame(rows, GRAPH)
    done = D.complete(graph, out=str(tmp_path / "out"))
    new = {(r.s, r.p, r.o) for r in done.collect()} - {r[:3] for r in rows}
    assert len(new) == 4 + len(tbox.COMPLETION) and any(s == TFL + "A" and p.endswith("#hasZone") for s, p, _ in new)
    assert "- Alpha" in sinks.read_text(spark, str(tmp_path / "out" / "completion_analysis.md"))
    assert D.complete(graph, Failing({"zone"})).count() == len(rows) + len(tbox.COMPLETION)


def test_owl_reasoning_axioms(spark):
    """The chain through the inverse makes stations reachable, and reachability is transitive."""
    from ternion.operators import graph as G

    seg = [(f"{TFL}seg{i}", p, f"{TFL}{s}") for i, (a, b) in enumerate([("A", "B"), ("B", "C")]) for p, s in ((TFL + "hasStartPoint", a), (TFL + "hasEndPoint", b))]
    graph = tbox.tbox(spark, reasoning=True).unionByName(spark.createDataFrame([(*r, "iri", "", "") for r in seg], GRAPH))
    got = {(r.s, r.o) for r in G.owl_closure(graph).where(f"p = '{TFL}reachableFrom'").collect()}
    assert {(TFL + "A", TFL + "B"), (TFL + "B", TFL + "C"), (TFL + "A", TFL + "C")} <= got
    bad = graph.unionByName(spark.createDataFrame([(TFL + "seg0", TFL + "hasStartPoint", TFL + "X", "iri", "", "")], GRAPH))
    assert [r.s for r in G.functional_violations(bad).collect()] == [TFL + "seg0"]


def test_rdfxml():
    text = '<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:e="http://e/" xml:base="http://b/"><e:T rdf:ID="x" e:k="v"><e:p rdf:resource="#y"/><e:q xml:lang="EN">hi</e:q><e:l rdf:parseType="Collection"><rdf:Description rdf:about="http://e/1"/></e:l><e:r rdf:parseType="Resource"><e:n rdf:datatype="http://d">5</e:n></e:r></e:T></rdf:RDF>'
    rows = list(parse_rdfxml(text, "s_"))
    have = {(r[1].split("/")[-1], *r[2:]) for r in rows if r[0] == "http://b/#x"}
    assert ("k", "v", "literal", "http://www.w3.org/2001/XMLSchema#string", "") in have and ("q", "hi", "literal", "", "en") in have and ("p", "http://b/#y", "iri", "", "") in have
    assert sum(r[3] == "bnode" for r in rows) == 2 and any(r[2] == "5" and r[4] == "http://d" for r in rows)
    assert parse_graph(text, "a.ttl") and parse_graph("<urn:a> <urn:b> <urn:c> .", "a.owl") == [("urn:a", "urn:b", "urn:c", "iri", "", "")]
    one, other = (parse_graph("_:k <urn:b> _:k .", p)[0][0] for p in ("a12.ttl", "a21.ttl"))
    assert one != other and one == parse_graph("_:k <urn:b> _:k .", "a12.ttl")[0][0]
    with pytest.raises(ValueError):
        parse_graph("neither < of > them", "a.ttl")
