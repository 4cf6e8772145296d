"""The base ontology and its alignment, as rows of a graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ternion.operators.graph import ZONE_NS
from ternion.schema import GRAPH, OWL, RDF, RDF_TYPE, RDFS, TFL, XSD

GTFS, GEO = "http://vocab.gtfs.org/terms#", "http://www.w3.org/2003/01/geo/wgs84_pos#"

#: Classes with their superclass, in the order of the ontology.
CLASSES = (
    ("AccessibilityFeature", None), ("FareClass", None), ("Journey", None), ("Route", None), ("RouteStopSequence", None), ("SpatialThing", None), ("StopTime", None), ("TransportMode", None), ("Zone", None), ("Fare", None), ("LineSegment", "SpatialThing"), ("Point", None),
    ("PeakFare", "Fare"), ("OffPeakFare", "Fare"), ("Line", "Route"), ("BusRoute", "Route"), ("TransitAccessPoint", "SpatialThing"), ("Station", "TransitAccessPoint"), ("TrainStation", "Station"), ("BusStop", "TransitAccessPoint"), ("InterchangeStation", "TrainStation"),
)
#: Classes of which no two share an instance.
DISJOINT = ("TransitAccessPoint", "Zone", "TransportMode", "Journey", "AccessibilityFeature", "Fare", "Route", "RouteStopSequence")
#: Object properties with domain and range.
OBJECT_PROPERTIES = (
    ("belongsToRoute", "RouteStopSequence", "Route"), ("directlyConnectedTo", "TransitAccessPoint", "TransitAccessPoint"), ("endPoint", "Journey", "TransitAccessPoint"), ("endZone", "Journey", "Zone"), ("hasFare", "Journey", "Fare"), ("hasStop", "Route", "TransitAccessPoint"),
    ("hasTransportMode", "TransitAccessPoint", "TransportMode"), ("hasZone", "TransitAccessPoint", "Zone"), ("offersAccessibilityFeature", "TransitAccessPoint", "AccessibilityFeature"), ("sequenceStop", "RouteStopSequence", "TransitAccessPoint"), ("servedByRoute", "TransitAccessPoint", "Route"),
    ("startPoint", "Journey", "TransitAccessPoint"), ("startZone", "TransitAccessPoint", "Zone"), ("hasStartPoint", "LineSegment", "TransitAccessPoint"), ("hasEndPoint", "LineSegment", "TransitAccessPoint"), ("onRoute", "LineSegment", "Route"), ("reachableFrom", "TransitAccessPoint", "TransitAccessPoint"),
)
#: Datatype properties with domain (none: any) and range.
DATATYPE_PROPERTIES = (("fareCost", "Fare", "decimal"), ("hasName", None, "string"), ("latitude", "TransitAccessPoint", "decimal"), ("longitude", "TransitAccessPoint", "decimal"), ("stopSequenceNumber", "RouteStopSequence", "integer"), ("zoneNumber", "Zone", "integer"))
#: Characteristics of properties.
CHARACTERISTICS = (("directlyConnectedTo", "SymmetricProperty"), ("reachableFrom", "TransitiveProperty"))
#: What the terms are in other vocabularies.
ALIGNMENT = (
    ("Route", OWL + "equivalentClass", GTFS + "Route"), ("Journey", OWL + "equivalentClass", GTFS + "Trip"), ("TransitAccessPoint", OWL + "equivalentClass", GTFS + "Stop"), ("TransitAccessPoint", RDFS + "subClassOf", GEO + "SpatialThing"), ("TrainStation", RDFS + "subClassOf", GTFS + "Station"),
    ("RouteStopSequence", OWL + "equivalentClass", GTFS + "StopTime"), ("Zone", OWL + "equivalentClass", GTFS + "Zone"), ("FareClass", RDFS + "subClassOf", GTFS + "FareClass"), ("hasZone", OWL + "equivalentProperty", GTFS + "zone"), ("stopSequenceNumber", OWL + "equivalentProperty", GTFS + "stopSequence"),
    ("sequenceStop", OWL + "equivalentProperty", GTFS + "stop"), ("hasName", RDFS + "subPropertyOf", GTFS + "shortName"), ("latitude", OWL + "equivalentProperty", GEO + "lat"), ("longitude", OWL + "equivalentProperty", GEO + "long"),
)
#: Axioms of the reasoning step: functional properties, an inverse, and a chain of two that makes stations reachable.
FUNCTIONAL, INVERSE, CHAIN = ("hasStartPoint", "hasEndPoint"), ("hasStartPoint", "isStartPointOf"), ("reachableFrom", ("isStartPointOf", "hasEndPoint"))
#: What completion adds about terms that the extraction met and the ontology lacks.
COMPLETION = (
    (TFL + "directlyConnectedTo", RDF_TYPE, OWL + "ObjectProperty"), (TFL + "servedByLine", RDF_TYPE, OWL + "ObjectProperty"), (TFL + "InterchangeStation", RDFS + "subClassOf", GTFS + "Station"),
    (TFL + "BusRoute", RDFS + "subClassOf", GTFS + "Route"), (TFL + "locatedInZone", RDFS + "subPropertyOf", ZONE_NS + "hasZone"),
)


def _list(head: str, items: list[str]) -> list[tuple[str, str, str, str]]:
    """The cells of a collection that begins at ``head``."""
    cells = [head, *(f"{head}-{i}" for i in range(1, len(items)))]
    rows = [(c, RDF + "first", x, "iri") for c, x in zip(cells, items, strict=True)]
    return rows + [(c, RDF + "rest", n, "bnode" if n in cells else "iri") for c, n in zip(cells, [*cells[1:], RDF + "nil"], strict=True)]


def tbox(spark: SparkSession, aligned: bool = True, reasoning: bool = False) -> DataFrame:
    """The ontology's axioms; with ``aligned`` its alignment, with ``reasoning`` the axioms of the reasoning step too."""
    term = lambda x: TFL + x
    rows = [(term(c), RDF_TYPE, OWL + "Class", "iri") for c, _ in CLASSES] + [(term(c), RDFS + "subClassOf", term(s), "iri") for c, s in CLASSES if s]
    rows += [("_:disjoint", RDF_TYPE, OWL + "AllDisjointClasses", "iri"), ("_:disjoint", OWL + "members", "_:members", "bnode"), *_list("_:members", [term(c) for c in DISJOINT])]
    for kind, properties, place in (("ObjectProperty", OBJECT_PROPERTIES, TFL), ("DatatypeProperty", DATATYPE_PROPERTIES, XSD)):
        for p, domain, range_ in properties:
            rows += [(term(p), RDF_TYPE, OWL + kind, "iri"), (term(p), RDFS + "range", place + range_, "iri")] + ([(term(p), RDFS + "domain", term(domain), "iri")] if domain else [])
    rows += [(term(p), RDF_TYPE, OWL + c, "iri") for p, c in CHARACTERISTICS]
    if aligned:
        rows += [(term(s), p, o, "iri") for s, p, o in ALIGNMENT]
    if reasoning:
        rows += [(term(p), RDF_TYPE, OWL + "FunctionalProperty", "iri") for p in FUNCTIONAL] + [(term(INVERSE[0]), OWL + "inverseOf", term(INVERSE[1]), "iri")]
        rows += [(term(CHAIN[0]), OWL + "propertyChainAxiom", "_:chain", "bnode"), *_list("_:chain", [term(p) for p in CHAIN[1]])]
    return spark.createDataFrame([(*r, "", "") for r in rows], GRAPH)


def disjoint_pairs(spark: SparkSession) -> DataFrame:
    """``(a, b)`` of the classes that share no instance, the earlier first."""
    return spark.createDataFrame([(TFL + a, TFL + b) for i, a in enumerate(DISJOINT) for b in DISJOINT[i + 1 :]], "a string, b string")
