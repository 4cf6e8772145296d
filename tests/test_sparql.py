"""The workload's constructs against hand-computed answers on a small graph."""

from pathlib import Path

import pytest

from ternion.plans.sparql import Engine, split_corpus
from ternion.plans.sparql.lower import tool_query
from ternion.schema import GRAPH
from ternion.sources.turtle import parse_turtle, to_ntriples, to_turtle, turtle_header

GOLDEN = (Path(__file__).parent / "golden.ttl").read_text()
P = "PREFIX : <http://example.org/tfl#>\n"
NS = "http://example.org/tfl#"


@pytest.fixture(scope="module")
def engine(spark):
    rows = sorted(set(parse_turtle(GOLDEN)))
    assert len(rows) == 126  # 117 facts and nine subclass axioms
    return Engine(spark.createDataFrame(rows, GRAPH).cache())


def ask(engine, text):
    return sorted((tuple(r) for r in engine.query(P + text).collect()), key=repr)


CASES = {
    "chain": ('SELECT ?n ?z WHERE { ?l :hasStop ?s ; :hasName ?x . FILTER(STR(?x) = "Red Line") ?s :hasName ?n ; :hasZone ?zz . ?zz :zoneNumber ?z . }',
              [("Alpha Station", "1"), ("Beta Station", "1"), ("Gamma Station", "2")]),
    "optional_flag": ('SELECT ?n (IF(BOUND(?i), "Yes", "No") AS ?f) WHERE { ?s :hasName ?t . FILTER(STR(?t) = "Beta Station") ?l :hasStop ?s ; :hasName ?n . OPTIONAL { ?s a :InterchangeStation . BIND(true AS ?i) } }',
                      [("Red Line", "No")]),
    "adjacent": ('SELECT ?n ?r WHERE { ?s :hasName "Beta Station" . ?a a :RouteStopSequence ; :sequenceStop ?s ; :belongsToRoute ?x ; :stopSequenceNumber ?i . ?b a :RouteStopSequence ; :belongsToRoute ?x ; :sequenceStop ?c ; :stopSequenceNumber ?j . FILTER(?j = ?i + 1 || ?j = ?i - 1) ?c :hasName ?n . ?x :hasName ?r . }',
                 [("Alpha Station", "Red Line"), ("Gamma Station", "Red Line")]),
    "having": ("SELECT ?n (COUNT(?l) AS ?c) WHERE { ?l :hasStop ?s . ?s :hasName ?n . } GROUP BY ?n HAVING (COUNT(?l) > 1)", [("Alpha Station", "2"), ("Gamma Station", "2")]),
    "literal_constant": ("SELECT DISTINCT ?n ?m WHERE { ?z :zoneNumber 1 . ?s :hasZone ?z ; :hasName ?n . ?l :hasStop ?s ; :hasName ?m . }",
                         [("Alpha Station", "Bus Route 9"), ("Alpha Station", "Red Line"), ("Beta Station", "Red Line")]),
    "coalesce": ('SELECT DISTINCT ?c ?t WHERE { ?j a :Journey ; :hasFare ?f . ?f :fareCost ?c . OPTIONAL { ?f a :PeakFare . BIND("Peak" AS ?p) } OPTIONAL { ?f a :OffPeakFare . BIND("Off-Peak" AS ?o) } BIND(COALESCE(?p, ?o, "Standard Fare") AS ?t) }',
                 [("2.80", "Off-Peak"), ("3.00", "Standard Fare"), ("3.40", "Peak")]),
    "path_optional": ("SELECT ?n ?d ?u WHERE { ?l rdf:type/rdfs:subClassOf* :Line ; :hasName ?n ; :openingDate ?d . OPTIONAL { ?p a :LineExpansion ; :targetsInfrastructure ?l ; :expectedCompletionDate ?u . } }",
                      [("Blue Line", "1906-03-10", None), ("Red Line", "1900-07-30", "2021-09-20")]),
    "union_paths": ("SELECT ?n ?x ?d WHERE { ?e rdf:type/rdfs:subClassOf* :PlannedDisruption ; :hasCause ?c ; :hasStatus ?s ; :disruptionDate ?d . ?c rdf:type/rdfs:subClassOf* :EngineeringWorks . { ?e :affectsStop ?a . } UNION { ?e :affectsRoute ?a . } ?a :hasName ?n . ?s rdfs:label ?x . }",
                    [("Alpha Station", "Minor Delays", "2024-01-02T00:00:00"), ("Red Line", "Minor Delays", "2024-01-02T00:00:00")]),
    "not_equal_unbound": ("SELECT ?n ?k ?d WHERE { ?p rdf:type/rdfs:subClassOf* :InfrastructureProject ; :hasProjectStatus ?s ; :targetsInfrastructure ?t ; :expectedCompletionDate ?d . FILTER(?s != :Completed) ?t :hasName ?n . }",
                          [("Alpha Station", None, "2030-01-01")]),
    "if_error": ('SELECT ?n (IF(?b, "24-Hour Service", "Limited Service") AS ?t) WHERE { ?r rdf:type/rdfs:subClassOf* :Route ; :hasName ?n . OPTIONAL { ?r :hasScheduleType :TwentyFourHourService . BIND(true AS ?b) } }',
                 [("Blue Line", None), ("Bus Route 9", None), ("Red Line", "24-Hour Service")]),
    "not_exists": ("SELECT ?n WHERE { ?s a :Station . ?s :hasName ?n FILTER NOT EXISTS { ?s :hasZone ?z } }", [("Epsilon Station",)]),
    "reach": ("SELECT ?a ?b WHERE { ?a (^:hasStartPoint/:hasEndPoint)+ ?b }", [(NS + x, NS + y) for x in "ABC" for y in "ABC"]),
}


@pytest.mark.parametrize("name", CASES)
def test_answers(engine, name):
    text, want = CASES[name]
    assert ask(engine, text) == sorted(want, key=repr)


def test_ordering(engine):
    got = engine.query(P + 'SELECT ?n ?q WHERE { ?r :hasName "Red Line" . ?x :belongsToRoute ?r ; :stopSequenceNumber ?q ; :sequenceStop ?s . ?s :hasName ?n . } ORDER BY ASC(?q)').collect()
    assert [r.q for r in got] == ["1", "2", "3"]
    got = engine.query(P + "SELECT ?k (COUNT(DISTINCT ?d) AS ?n) WHERE { ?d rdf:type/rdfs:subClassOf* :ServiceDisruption ; :hasCause ?c . ?c a ?k . FILTER(?k != :DisruptionCause && ?k != owl:NamedIndividual) } GROUP BY ?k ORDER BY DESC(?n)").collect()
    assert got[0].k == NS + "SignalFailure" and [r.n for r in got] == ["2", "1", "1"]


def test_tool_and_errors(engine):
    assert tool_query(engine, P + "SELECT ?x WHERE { ?x a :Nothing }") == []
    assert "error" in tool_query(engine, "SELECT nonsense")[0]
    got = tool_query(engine, P + "SELECT ?x ?u WHERE { ?x a :Zone }")
    assert len(got) == 2 and got[0]["u"] == "None"
    assert engine.query(P + "ASK { ?x a :Zone }").first().ask


def test_round_trip(engine, spark):
    want = {r[:3] for r in parse_turtle(GOLDEN)}
    text = "\n".join(r.value for r in to_ntriples(engine.triples).collect())
    assert {r[:3] for r in parse_turtle(text)} == want
    text = turtle_header() + "\n".join(r.value for r in to_turtle(engine.triples).collect())
    assert {r[:3] for r in parse_turtle(text)} == want


def test_turtle_syntax():
    rows = list(parse_turtle('@prefix : <urn:x#> .\n:a :p [ :q ( "it\'s" "b"@en ) ] , 1.5 ; a :T . # note\n:b :r """long\n"x" text""" .'))
    assert ("urn:x#a", "urn:x#p", "1.5", "literal", "http://www.w3.org/2001/XMLSchema#decimal", "") in rows
    assert any(r[2] == "it's" for r in rows) and any(r[2] == "b" and r[5] == "en" for r in rows)
    assert ("urn:x#b", "urn:x#r", 'long\n"x" text', "literal", "http://www.w3.org/2001/XMLSchema#string", "") in rows


def test_corpus_splitter():
    text = "# ====\n# Q1: first?\n# ====\nSELECT ?a WHERE { ?a ?b ?c }\n\n# ====\n# Q6: second?\n# Another comment line.\n# ====\nASK { }\n"
    got = split_corpus(text)
    assert [t for t, _ in got] == ["Q1: first?", "Q6: second?"] and got[1][1] == "ASK { }"
