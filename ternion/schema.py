"""Schemas, namespaces and rule tables shared by all stages."""

from __future__ import annotations

#: Namespaces and terms of the graphs that are read and written.
TFL = "http://example.org/tfl#"
PT = "http://example.org/pt#"
OWL = "http://www.w3.org/2002/07/owl#"
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
XSD = "http://www.w3.org/2001/XMLSchema#"
PROV = "http://www.w3.org/ns/prov#"
RDF_TYPE = RDF + "type"
PREFIXES = {"pt": PT, "owl": OWL, "rdf": RDF, "rdfs": RDFS, "xsd": XSD, "prov": PROV}

#: triples as rules and validation see them, and as a graph with term kinds.
TRIPLES = "s string, p string, o string, is_literal boolean, datatype string"
GRAPH = "s string, p string, o string, o_kind string, datatype string, lang string"

TRIPLETS = "doc_id string, seq long, source string, subject string, predicate string, object string, provenance_sentence string"
CATALOG = "base_category string, name string, kind string, label string, comment string, symmetric boolean, transitive boolean, functional boolean"
SCHEMA_CATALOG = "ord long, role string, label string, iri string"

#: The schema catalogs that stand behind every learned one, as (label, local name).
DEFAULT_CLASSES = ("TransportEntity", "Operator", "Service", "Ticket", "PassengerRight", "PenaltyFarePolicy")
DEFAULT_PREDICATES = (
    ("operated by", "operatedBy"),
    ("operates", "operates"),
    ("applies to", "appliesTo"),
    ("eligible for refund", "eligibleForRefund"),
    ("has penalty fare", "hasPenaltyFare"),
    ("has compensation right", "hasCompensationRight"),
    ("related to", "relatedTo"),
)

#: Rules as data: (kind, predicate, inverse).
RULES = (("inverse", PT + "operates", PT + "operatedBy"), ("inverse", PT + "operatedBy", PT + "operates"), ("symmetric", PT + "relatedTo", PT + "relatedTo"))
CONNECTED = PT + "ConnectedEntity"
