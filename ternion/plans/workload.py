"""The competency workload over the relational tables as a graph, and text functions, each with its SQL.

Orders stand for routes, line items for stops in a sequence, parts for stations, regions for zones, events
for disruptions. Tables become triples by projection, a predicate at a time, and a pattern reads its predicate's alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ternion.functions import text as T
from ternion.operators import linking as L
from ternion.plans.sparql import Engine
from ternion.schema import RDF_TYPE, RDFS, XSD

NS = "http://example.org/tfl#"
_P = f"PREFIX : <{NS}>\n"

#: Class tree beside the tables: (class, superclass).
TREE = (("Line", "Route"), ("BusRoute", "Route"), ("PlannedDisruption", "ServiceDisruption"), ("UnplannedDisruption", "ServiceDisruption"), ("SignalFailure", "TechnicalFault"), ("TechnicalFault", "DisruptionCause"), ("click", "PlannedDisruption"), ("error", "SignificantDisruption"), ("SignificantDisruption", "ServiceDisruption"), ("Strike", "IndustrialAction"), ("LineExpansion", "InfrastructureProject"))


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _iri(kind: str, *keys: str) -> Column:
    return F.concat_ws("-", F.lit(NS + kind), *[F.col(k).cast("string") for k in keys])


def _rows(df: DataFrame, s: Column, p: str, o: Column, kind: str = "iri", dt: str = "") -> tuple[str, DataFrame]:
    return p, df.select(s.alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"), F.lit(dt).alias("datatype"), F.lit("").alias("lang"))


def network(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The tables as a graph: the triples of each predicate."""
    text, whole = XSD + "string", XSD + "integer"
    part, orders, items, region, events, supplier = (table(spark, d, x) for x in ("part", "orders", "lineitem", "region", "events", "supplier"))
    station, route, seq, zone, event = _iri("part", "p_partkey"), _iri("order", "o_orderkey"), _iri("seq", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), _iri("zone", "r_regionkey"), _iri("event", "event_id")
    name = lambda label, key: F.concat(F.lit(label + " "), F.col(key).cast("string"))
    tree = spark.createDataFrame([(NS + a, RDFS + "subClassOf", NS + b, "iri", "", "") for a, b in TREE], "s string, p string, o string, o_kind string, datatype string, lang string")
    parts = [
        _rows(part, station, NS + "hasName", name("Part", "p_partkey"), "literal", text),
        _rows(part.where("p_partkey % 7 <> 0"), station, NS + "hasZone", F.concat(F.lit(NS + "zone-"), (F.col("p_partkey") % 5).cast("string"))),
        _rows(part, station, RDF_TYPE, F.when(F.col("p_size") > 40, NS + "InterchangeStation").otherwise(NS + "Station")),
        _rows(part, station, NS + "offersAccessibilityFeature", F.concat(F.lit(NS + "brand-"), F.replace("p_brand", F.lit("#"), F.lit("")))),
        _rows(part.select("p_brand").distinct(), F.concat(F.lit(NS + "brand-"), F.replace("p_brand", F.lit("#"), F.lit(""))), NS + "hasName", F.col("p_brand"), "literal", text),
        _rows(region, zone, NS + "zoneNumber", (F.col("r_regionkey") + 1).cast("string"), "literal", whole),
        _rows(orders, route, NS + "hasName", name("Order", "o_orderkey"), "literal", text),
        _rows(orders, route, RDF_TYPE, F.when(F.col("o_orderpriority").startswith("1"), NS + "Line").otherwise(NS + "BusRoute")),
        _rows(orders.where("o_orderstatus = 'F'"), route, NS + "hasScheduleType", F.lit(NS + "TwentyFourHourService")),
        _rows(orders, route, NS + "openingDate", F.date_format("o_orderdate", "yyyy-MM-dd"), "literal", XSD + "date"),
        _rows(items.select("l_orderkey", "l_partkey").distinct(), _iri("order", "l_orderkey"), NS + "hasStop", _iri("part", "l_partkey")),
        _rows(items, seq, RDF_TYPE, F.lit(NS + "RouteStopSequence")),
        _rows(items, seq, NS + "belongsToRoute", _iri("order", "l_orderkey")),
        _rows(items, seq, NS + "sequenceStop", _iri("part", "l_partkey")),
        _rows(items, seq, NS + "stopSequenceNumber", F.col("l_linenumber").cast("string"), "literal", whole),
        _rows(events, event, RDF_TYPE, F.concat(F.lit(NS), F.col("event_type"))),
        _rows(events, event, NS + "affectsUser", _iri("user", "user_id")),
        _rows(events.where("event_type = 'click'"), event, NS + "affectsRoute", _iri("order", "user_id")),
        _rows(events.where("event_type = 'error'"), event, NS + "affectsStop", _iri("part", "user_id")),
        _rows(events, event, NS + "hasStatus", _iri("status", "event_type")),
        _rows(events, event, NS + "hasCause", _iri("cause", "event_type")),
        _rows(events, event, NS + "disruptionDate", F.date_format("ts", "yyyy-MM-dd"), "literal", XSD + "date"),
        _rows(events.select("event_type").distinct(), _iri("status", "event_type"), RDFS + "label", F.concat(F.lit("Status "), "event_type"), "literal", text),
        _rows(events.where("event_type <> 'view'").select("event_type").distinct(), _iri("cause", "event_type"), RDF_TYPE, F.lit(NS + "Strike")),
        _rows(orders, route, NS + "operationStartTime", F.concat(F.lit("0"), (F.col("o_orderkey") % 10).cast("string"), F.lit(":00:00")), "literal", XSD + "time"),
        _rows(orders, route, NS + "operationEndTime", F.lit("23:30:00"), "literal", XSD + "time"),
        _rows(orders.where("o_orderstatus <> 'P'"), route, NS + "operatingDays", F.concat(F.lit("days "), "o_orderstatus"), "literal", text),
        _rows(orders, route, NS + "hasPeakPeriod", _iri("peak", "o_orderstatus")),
        _rows(orders, route, NS + "hasOffPeakPeriod", _iri("offpeak", "o_orderstatus")),
        *[_rows(orders.select("o_orderstatus").distinct(), _iri(k, "o_orderstatus"), NS + p, F.concat(F.lit(f"{h}:00:0"), F.length("o_orderstatus").cast("string")), "literal", XSD + "time") for k, p, h in (("peak", "startTime", "07"), ("peak", "endTime", "10"), ("offpeak", "startTime", "11"), ("offpeak", "endTime", "16"))],
        _rows(supplier, _iri("project", "s_suppkey"), RDF_TYPE, F.lit(NS + "LineExpansion")),
        _rows(supplier, _iri("project", "s_suppkey"), NS + "targetsInfrastructure", _iri("order", "s_suppkey")),
        _rows(supplier, _iri("project", "s_suppkey"), NS + "hasProjectStatus", F.when(F.col("s_suppkey") % 2 == 0, NS + "Completed").otherwise(NS + "Planned")),
        _rows(supplier, _iri("project", "s_suppkey"), NS + "expectedCompletionDate", F.concat((F.col("s_suppkey") + 2000).cast("string"), F.lit("-01-01")), "literal", XSD + "date"),
        (RDFS + "subClassOf", tree),
    ]
    out: dict[str, DataFrame] = {}
    for predicate, rows in parts:
        out[predicate] = out[predicate].unionByName(rows) if predicate in out else rows
    return out


#: name: (SPARQL over `network`, the same in SQL over the tables).
_SEQ = "(SELECT DISTINCT l_orderkey AS r, l_partkey AS p, l_linenumber AS n, l_suppkey AS q FROM lineitem)"
SPARQL: dict[str, tuple[str, str]] = {
    "sparql_q1_line_stations_zones": (
        'SELECT ?stationName ?zoneNum WHERE { ?line :hasStop ?s ; :hasName ?n . FILTER(STR(?n) = "Order 7") ?s :hasName ?stationName ; :hasZone ?z . ?z :zoneNumber ?zoneNum . }',
        "SELECT 'Part ' || l_partkey AS \"stationName\", CAST(l_partkey % 5 + 1 AS VARCHAR) AS \"zoneNum\" FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_orderkey = 7) WHERE l_partkey % 7 <> 0",
    ),
    "sparql_q2_optional_flag": (
        'SELECT ?lineName (IF(BOUND(?i), "Yes", "No") AS ?interchange) WHERE { ?s :hasName ?t . FILTER(STR(?t) = "Part 10") ?l :hasStop ?s ; :hasName ?lineName . OPTIONAL { ?s a :InterchangeStation . BIND(true AS ?i) } }',
        "SELECT DISTINCT 'Order ' || l_orderkey AS \"lineName\", CASE WHEN p_size > 40 THEN 'Yes' ELSE 'No' END AS interchange FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_partkey = 10",
    ),
    "sparql_q3_ordered_stops": (
        'SELECT ?stopName ?seq WHERE { ?r :hasName ?t . FILTER(STR(?t) = "Order 7") ?x :belongsToRoute ?r ; :stopSequenceNumber ?seq ; :sequenceStop ?s . ?s :hasName ?stopName . } ORDER BY ASC(?seq)',
        "SELECT 'Part ' || l_partkey AS \"stopName\", CAST(l_linenumber AS VARCHAR) AS seq FROM (SELECT DISTINCT l_orderkey, l_partkey, l_linenumber, l_suppkey FROM lineitem) WHERE l_orderkey = 7",
    ),
    "sparql_q4_adjacent_stops": (
        'SELECT ?name ?route WHERE { ?s :hasName ?t . FILTER(STR(?t) = "Part 10") ?a a :RouteStopSequence ; :sequenceStop ?s ; :belongsToRoute ?r ; :stopSequenceNumber ?i . ?b a :RouteStopSequence ; :belongsToRoute ?r ; :sequenceStop ?c ; :stopSequenceNumber ?j . FILTER(?j = ?i + 1 || ?j = ?i - 1) ?c :hasName ?name . ?r :hasName ?route . }',
        f"SELECT 'Part ' || b.p AS name, 'Order ' || a.r AS route FROM {_SEQ} a JOIN {_SEQ} b ON a.r = b.r AND (b.n = a.n + 1 OR b.n = a.n - 1) WHERE a.p = 10",
    ),
    "sparql_q5_interchanges": (
        "SELECT ?stationName (COUNT(?l) AS ?linesServed) WHERE { ?l :hasStop ?s . ?s :hasName ?stationName . } GROUP BY ?stationName HAVING (COUNT(?l) > 1)",
        "SELECT 'Part ' || l_partkey AS \"stationName\", CAST(count(DISTINCT l_orderkey) AS VARCHAR) AS \"linesServed\" FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_orderkey) > 1",
    ),
    "sparql_q6_routes": (
        """SELECT ?stationsList ?routesList WHERE { ?a :hasName ?an . ?b :hasName ?bn . FILTER(STR(?an) = "Part 10") FILTER(STR(?bn) = "Part 20")
        { ?s1 a :RouteStopSequence ; :sequenceStop ?a ; :belongsToRoute ?r1 ; :stopSequenceNumber ?m1 . ?e1 a :RouteStopSequence ; :sequenceStop ?b ; :belongsToRoute ?r1 ; :stopSequenceNumber ?n1 . FILTER(?m1 < ?n1)
          ?a :hasName ?x . ?b :hasName ?y . ?r1 :hasName ?q1 . BIND(CONCAT("[", ?x, ", ", ?y, "]") AS ?stationsList) BIND(CONCAT("[", ?q1, "]") AS ?routesList) } UNION
        { ?s1 a :RouteStopSequence ; :sequenceStop ?a ; :belongsToRoute ?r1 ; :stopSequenceNumber ?m1 . ?e1 a :RouteStopSequence ; :sequenceStop ?c ; :belongsToRoute ?r1 ; :stopSequenceNumber ?n1 . FILTER(?m1 < ?n1)
          ?s2 a :RouteStopSequence ; :sequenceStop ?c ; :belongsToRoute ?r2 ; :stopSequenceNumber ?m2 . ?e2 a :RouteStopSequence ; :sequenceStop ?b ; :belongsToRoute ?r2 ; :stopSequenceNumber ?n2 . FILTER(?m2 < ?n2) FILTER(?r1 != ?r2)
          ?a :hasName ?x . ?b :hasName ?y . ?r1 :hasName ?q1 . ?c a :InterchangeStation ; :hasName ?z . ?r2 :hasName ?q2 . BIND(CONCAT("[", ?x, ", ", ?z, ", ", ?y, "]") AS ?stationsList) BIND(CONCAT("[", ?q1, ", ", ?q2, "]") AS ?routesList) } UNION
        { ?s1 a :RouteStopSequence ; :sequenceStop ?a ; :belongsToRoute ?r1 ; :stopSequenceNumber ?m1 . ?e1 a :RouteStopSequence ; :sequenceStop ?c ; :belongsToRoute ?r1 ; :stopSequenceNumber ?n1 . FILTER(?m1 < ?n1)
          ?s2 a :RouteStopSequence ; :sequenceStop ?c ; :belongsToRoute ?r2 ; :stopSequenceNumber ?m2 . ?e2 a :RouteStopSequence ; :sequenceStop ?g ; :belongsToRoute ?r2 ; :stopSequenceNumber ?n2 . FILTER(?m2 < ?n2) FILTER(?r1 != ?r2)
          ?s3 a :RouteStopSequence ; :sequenceStop ?g ; :belongsToRoute ?r3 ; :stopSequenceNumber ?m3 . ?e3 a :RouteStopSequence ; :sequenceStop ?b ; :belongsToRoute ?r3 ; :stopSequenceNumber ?n3 . FILTER(?m3 < ?n3) FILTER(?r2 != ?r3)
          ?a :hasName ?x . ?b :hasName ?y . ?r1 :hasName ?q1 . ?c a :InterchangeStation ; :hasName ?z . ?g a :InterchangeStation ; :hasName ?w . ?r2 :hasName ?q2 . ?r3 :hasName ?q3 .
          BIND(CONCAT("[", ?x, ", ", ?z, ", ", ?w, ", ", ?y, "]") AS ?stationsList) BIND(CONCAT("[", ?q1, ", ", ?q2, ", ", ?q3, "]") AS ?routesList) } }""",
        f"""WITH l AS MATERIALIZED (SELECT s.r, s.p AS a, e.p AS b FROM {_SEQ} s JOIN {_SEQ} e ON s.r = e.r AND s.n < e.n), i AS MATERIALIZED (SELECT p_partkey AS k FROM part WHERE p_size > 40)
        SELECT '[Part 10, Part 20]' AS "stationsList", '[Order ' || r || ']' AS "routesList" FROM l WHERE a = 10 AND b = 20
        UNION ALL SELECT '[Part 10, Part ' || x.b || ', Part 20]', '[Order ' || x.r || ', Order ' || y.r || ']' FROM l x JOIN i ON x.b = k JOIN l y ON y.a = x.b AND y.r <> x.r WHERE x.a = 10 AND y.b = 20
        UNION ALL SELECT '[Part 10, Part ' || x.b || ', Part ' || y.b || ', Part 20]', '[Order ' || x.r || ', Order ' || y.r || ', Order ' || z.r || ']' FROM l x JOIN i ON x.b = i.k JOIN l y ON y.a = x.b AND y.r <> x.r JOIN i j ON y.b = j.k JOIN l z ON z.a = y.b AND z.r <> y.r WHERE x.a = 10 AND z.b = 20""",
    ),
    "sparql_q7_zone_services": (
        "SELECT DISTINCT ?stationName ?lineName WHERE { ?z :zoneNumber 1 . ?s :hasZone ?z ; :hasName ?stationName . ?l :hasStop ?s ; :hasName ?lineName . }",
        "SELECT DISTINCT 'Part ' || l_partkey AS \"stationName\", 'Order ' || l_orderkey AS \"lineName\" FROM lineitem WHERE l_partkey % 5 = 0 AND l_partkey % 7 <> 0",
    ),
    "sparql_q8_feature": (
        'SELECT ?stationName WHERE { ?f :hasName ?t . FILTER(STR(?t) = "Brand#11") ?s :offersAccessibilityFeature ?f ; :hasName ?stationName . }',
        "SELECT 'Part ' || p_partkey AS \"stationName\" FROM part WHERE p_brand = 'Brand#11'",
    ),
    "sparql_q9_coalesce": (
        'SELECT DISTINCT ?name ?kind WHERE { ?r :openingDate ?d ; :hasName ?name . OPTIONAL { ?r a :Line . BIND("Peak" AS ?p) } OPTIONAL { ?r :hasScheduleType :TwentyFourHourService . BIND("Off-Peak" AS ?o) } BIND(COALESCE(?p, ?o, "Standard Fare") AS ?kind) }',
        "SELECT 'Order ' || o_orderkey AS name, CASE WHEN o_orderpriority LIKE '1%' THEN 'Peak' WHEN o_orderstatus = 'F' THEN 'Off-Peak' ELSE 'Standard Fare' END AS kind FROM orders",
    ),
    "sparql_q11_path_optional": (
        "SELECT ?name ?date ?sched WHERE { ?r rdf:type/rdfs:subClassOf* :Line ; :hasName ?name ; :openingDate ?date . OPTIONAL { ?r :hasScheduleType ?sched . } }",
        f"SELECT 'Order ' || o_orderkey AS name, strftime(o_orderdate, '%Y-%m-%d') AS date, CASE WHEN o_orderstatus = 'F' THEN '{NS}TwentyFourHourService' END AS sched FROM orders WHERE o_orderpriority LIKE '1%'",
    ),
    "sparql_q12_union_paths": (
        "SELECT ?e ?u WHERE { ?e rdf:type/rdfs:subClassOf* :PlannedDisruption . { ?e :affectsUser ?u . } UNION { ?e :affectsStop ?u . } }",
        f"SELECT '{NS}event-' || event_id AS e, '{NS}user-' || user_id AS u FROM events WHERE event_type = 'click'",
    ),
    "sparql_q13_opening_times": (
        'SELECT ?routeName ?openTime ?closeTime ?days WHERE { ?route rdf:type/rdfs:subClassOf* :Route ; :hasName ?routeName ; :operationStartTime ?openTime ; :operationEndTime ?closeTime ; :operatingDays ?days . }',
        "SELECT 'Order ' || o_orderkey AS \"routeName\", '0' || (o_orderkey % 10) || ':00:00' AS \"openTime\", '23:30:00' AS \"closeTime\", 'days ' || o_orderstatus AS days FROM orders WHERE o_orderstatus <> 'P'",
    ),
    "sparql_q14_disruptions": (
        "SELECT DISTINCT ?affectedName ?statusLabel WHERE { ?disruption a ?disruptionType ; :hasStatus ?status . { ?disruption :affectsRoute ?affected . } UNION { ?disruption :affectsStop ?affected . } ?affected :hasName ?affectedName . ?status rdfs:label ?statusLabel . }",
        "SELECT DISTINCT 'Order ' || o_orderkey AS \"affectedName\", 'Status click' AS \"statusLabel\" FROM events JOIN orders ON o_orderkey = user_id WHERE event_type = 'click' UNION SELECT 'Part ' || p_partkey, 'Status error' FROM events JOIN part ON p_partkey = user_id WHERE event_type = 'error'",
    ),
    "sparql_q15_expansions": (
        "SELECT ?lineName ?completionDate WHERE { ?line rdf:type/rdfs:subClassOf* :Line ; :hasName ?lineName . ?project a :LineExpansion ; :targetsInfrastructure ?line ; :hasProjectStatus :Completed ; :expectedCompletionDate ?completionDate . }",
        "SELECT 'Order ' || o_orderkey AS \"lineName\", (2000 + s_suppkey) || '-01-01' AS \"completionDate\" FROM orders JOIN supplier ON s_suppkey = o_orderkey WHERE o_orderpriority LIKE '1%' AND s_suppkey % 2 = 0",
    ),
    "sparql_q16_projects": (
        "SELECT ?targetName ?projectType ?expectedDate WHERE { ?project rdf:type/rdfs:subClassOf* :InfrastructureProject ; :hasProjectStatus ?status ; :targetsInfrastructure ?target ; :expectedCompletionDate ?expectedDate . FILTER(?status != :Completed) ?target :hasName ?targetName . }",
        "SELECT 'Order ' || o_orderkey AS \"targetName\", NULL AS \"projectType\", (2000 + s_suppkey) || '-01-01' AS \"expectedDate\" FROM orders JOIN supplier ON s_suppkey = o_orderkey WHERE s_suppkey % 2 = 1",
    ),
    "sparql_q16_not_equal": (
        "SELECT ?name ?kind WHERE { ?r rdf:type/rdfs:subClassOf* :Route ; :hasName ?name ; a ?t . FILTER(?t != :Line) }",
        "SELECT 'Order ' || o_orderkey AS name, NULL AS kind FROM orders WHERE o_orderpriority NOT LIKE '1%'",
    ),
    "sparql_q17_peak_times": (
        "SELECT ?lineName ?peakStart ?peakEnd ?offPeakStart ?offPeakEnd WHERE { ?line rdf:type/rdfs:subClassOf* :Line ; :hasName ?lineName ; :hasPeakPeriod ?peak ; :hasOffPeakPeriod ?offPeak . ?peak :startTime ?peakStart ; :endTime ?peakEnd . ?offPeak :startTime ?offPeakStart ; :endTime ?offPeakEnd . }",
        "SELECT 'Order ' || o_orderkey AS \"lineName\", '07:00:01' AS \"peakStart\", '10:00:01' AS \"peakEnd\", '11:00:01' AS \"offPeakStart\", '16:00:01' AS \"offPeakEnd\" FROM orders WHERE o_orderpriority LIKE '1%'",
    ),
    "sparql_q18_if_error": (
        'SELECT ?name (IF(?b, "24-Hour Service", "Limited Service") AS ?service) WHERE { ?r rdf:type/rdfs:subClassOf* :Route ; :hasName ?name . OPTIONAL { ?r :hasScheduleType :TwentyFourHourService . BIND(true AS ?b) } }',
        "SELECT 'Order ' || o_orderkey AS name, CASE WHEN o_orderstatus = 'F' THEN '24-Hour Service' END AS service FROM orders",
    ),
    "sparql_q19_strikes": (
        "SELECT ?affectedName ?disruptionDate WHERE { ?disruption rdf:type/rdfs:subClassOf* :SignificantDisruption ; :hasCause ?cause ; :disruptionDate ?disruptionDate . ?cause rdf:type/rdfs:subClassOf* :IndustrialAction . { ?disruption :affectsRoute ?affected . } UNION { ?disruption :affectsStop ?affected . } ?affected :hasName ?affectedName . }",
        "SELECT 'Part ' || p_partkey AS \"affectedName\", strftime(ts, '%Y-%m-%d') AS \"disruptionDate\" FROM events JOIN part ON p_partkey = user_id WHERE event_type = 'error'",
    ),
    "sparql_q20_cause_counts": (
        "SELECT ?kind (COUNT(DISTINCT ?e) AS ?total) WHERE { ?e :affectsUser ?u ; a ?kind . FILTER(?kind != :view && ?kind != owl:NamedIndividual) } GROUP BY ?kind ORDER BY DESC(?total)",
        f"SELECT '{NS}' || event_type AS kind, CAST(count(DISTINCT event_id) AS VARCHAR) AS total FROM events WHERE event_type <> 'view' GROUP BY event_type",
    ),
    "gap_not_exists": (
        "SELECT DISTINCT ?station ?name WHERE { { ?station a :InterchangeStation } UNION { ?station a :Station } { ?station rdfs:label ?name } UNION { ?station :hasName ?name } FILTER NOT EXISTS { ?station :hasZone ?z } FILTER NOT EXISTS { ?station :locatedInZone ?z } }",
        f"SELECT '{NS}part-' || p_partkey AS station, 'Part ' || p_partkey AS name FROM part WHERE p_partkey % 7 = 0",
    ),
}


def _sparql(text: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: Engine(parts=network(spark, d)).query(_P + text)


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


_COS = "list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"


def _knn(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select(F.lpad(F.col("vec_id").cast("string"), 9, "0").alias("name"), F.col("label").cast("string").alias("kind"), F.col("embedding").alias("vec"), "vec_id")
    return L.knn(e.where("vec_id % 20 = 0"), e).select("name", "near", "kind", "rank")


_WS = r"'\s+'"
_SENT = r"list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x, ' ' || chr(10) || chr(9) || chr(13))), lambda x: x <> '')"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: _sparql(v[0]) for k, v in SPARQL.items()} | {
    "text_normalize": lambda s, d: _docs(s, d).select("doc_id", T.collapse(F.col("text")).alias("text")),
    "text_sentences": lambda s, d: _docs(s, d).select("doc_id", F.posexplode(T.sentences(F.col("text"))).alias("n", "sentence")),
    "text_tokens": lambda s, d: _docs(s, d).select("doc_id", F.explode(T.tokens(F.col("text"))).alias("token")).groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n")),
    "slug": lambda s, d: table(s, d, "part").select("p_partkey", T.slug(F.col("p_type")).alias("slug"), T.equality_norm(F.col("p_name")).alias("norm")),
    "block_tokens": lambda s, d: table(s, d, "part").select("p_partkey", F.explode(T.block_tokens(F.col("p_name"))).alias("token")),
    "knn_topk": _knn,
    "hash_documents": lambda s, d: _docs(s, d).select("doc_id", F.sha2("text", 256).alias("sha256")),
}

ORACLE: dict[str, str] = {k: v[1] for k, v in SPARQL.items()} | {
    "text_normalize": f"SELECT doc_id, trim(regexp_replace(text, {_WS}, ' ', 'g')) AS text FROM documents",
    "text_sentences": f"SELECT doc_id, CAST(unnest(range(len(s))) AS INTEGER) AS n, unnest(s) AS sentence FROM (SELECT doc_id, {_SENT} AS s FROM documents)",
    "text_tokens": "SELECT doc_id, token, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[\\p{L}\\p{N}_]+')) AS token FROM documents) GROUP BY doc_id, token",
    "slug": "SELECT p_partkey, regexp_replace(regexp_replace(p_type, '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS norm FROM part",
    "block_tokens": "SELECT DISTINCT p_partkey, token FROM (SELECT p_partkey, unnest(regexp_extract_all(lower(p_name), '[a-z0-9]+')) AS token FROM part) WHERE length(token) > 2 AND token NOT IN (" + ", ".join(f"'{w}'" for w in T.STOP_WORDS) + ")",
    "knn_topk": f"SELECT name, near, kind, rank FROM (SELECT lpad(CAST(a.vec_id AS VARCHAR), 9, '0') AS name, lpad(CAST(b.vec_id AS VARCHAR), 9, '0') AS near, CAST(b.label AS VARCHAR) AS kind, row_number() OVER (PARTITION BY a.vec_id ORDER BY {_COS} DESC, b.vec_id DESC) AS rank FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0) WHERE rank <= 3",
    "hash_documents": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
}
