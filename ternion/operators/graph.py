"""From triplets to a typed graph: schema mapping, construction, rules, validation, completion."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ternion.functions import text as T
from ternion.functions.parsing import ratio_from
from ternion.operators.closure import transitive_closure
from ternion.plans.lineage import cut, ranked
from ternion.schema import CONNECTED, DEFAULT_CLASSES, DEFAULT_PREDICATES, OWL, PROV, PT, RDF_TYPE, RDFS, RULES, SCHEMA_CATALOG, TFL, TRIPLES, XSD

CLASS_LEAST, PREDICATE_LEAST = 0.6, 0.66
#: The base ontology's namespace and its class of zones.
ZONE_NS, ZONE_CLASS = "urn:webprotege:ontology:c73d2ce1-09f8-451b-b6fd-d3ba1ee14c49#", "http://webprotege.stanford.edu/R7cZlQsX1sMesyLmlHKw2lg"
#: The default catalog entries stand behind all learned ones, whose ``ord`` is smaller.
LEARNED_BELOW = 10**12


def schema_catalog(spark: SparkSession, learned: DataFrame | None = None) -> DataFrame:
    """Learned classes and predicates in their order, the default ones behind them."""
    rows = [("classes", x, TFL + x) for x in DEFAULT_CLASSES] + [("predicates", x, TFL + y) for x, y in DEFAULT_PREDICATES]
    default = spark.createDataFrame([(LEARNED_BELOW + i, *r) for i, r in enumerate(rows)], SCHEMA_CATALOG)
    return default if learned is None else learned.select(*default.columns).unionByName(default)


def _form(side: DataFrame) -> Callable[[Column], Column]:
    """A normal label with every character that no entry (``norm``) has as one and the same mark: its ratio to each entry stays what it was."""
    chars = {r[0] for r in side.select(F.explode(F.split("norm", "")).alias("c")).distinct().collect()} - {""}
    mark = next(chr(i) for i in range(0xE000, 0xF900) if chr(i) not in chars)
    other = "[^" + "".join(f"\\x{{{ord(c):x}}}" for c in sorted(chars)) + "]" if chars else "(?s)."
    return lambda label: F.regexp_replace(T.label_norm(label), other, mark)


def best_match(labels: DataFrame, catalog: DataFrame, role: str, least: float = 0.0) -> DataFrame:
    """The best catalog entry of each distinct label by matching ratio (> 0, ``least`` or more), the first of equals: label, iri, match, score.

    The ratio sees where characters are equal. Those that no entry has never are, so labels that differ in them alone
    (as by their numbers) share a form, and a form is compared once.
    """
    side = cut(catalog.where(F.col("role") == role).select("ord", F.col("label").alias("match"), "iri", T.label_norm(F.col("label")).alias("norm")), "catalog")
    form = _form(side)
    formed = labels.select("label", form(F.col("label")).alias("form"))
    pairs = formed.select("form").distinct().crossJoin(F.broadcast(side))  # the catalog is schema, not data
    scored = pairs.withColumn("score", ratio_from(least)(F.col("form"), F.col("norm"))).where("score > 0")
    best = scored.groupBy("form").agg(F.max_by(F.struct("iri", "match", "score"), F.struct("score", -F.col("ord"))).alias("x"))
    return formed.join(cut(best.select("form", "x.*"), "matches"), "form").select("label", "iri", "match", "score").distinct()


def map_nodes(t: DataFrame, names: DataFrame, catalog: DataFrame, closed: bool = True, demote: bool = False) -> DataFrame:
    """One node per name of a triplet end that is no literal. ``names``: name, kind, label, comment.

    Names are numbered from 1 in ascending order, left-out ones too. With ``closed``, a class whose raw name is no
    label of a learned class is left out (``demote``: it becomes an individual). IRIs and matches follow the raw
    name, labels what ``names`` says.
    """
    ends = t.select(F.col("subject").alias("name")).union(t.where(~T.is_literal(F.col("object"))).select("object")).distinct()
    numbered = ranked(ends, "name", name="n")
    known = numbered.join(names.select("name", "kind", F.col("label").alias("shown"), "comment"), "name", "left").select("n", "name", F.coalesce("kind", F.lit("individual")).alias("kind"), F.coalesce("shown", "name").alias("label"), F.coalesce("comment", F.lit("")).alias("comment"))
    if closed:
        learned = catalog.where((F.col("role") == "classes") & (F.col("ord") < LEARNED_BELOW)).select(T.label_norm(F.col("label")).alias("norm"), F.lit(True).alias("old")).distinct()
        known = known.withColumn("norm", T.label_norm(F.col("name"))).join(F.broadcast(learned), "norm", "left").drop("norm")
        fresh = (F.col("kind") == "class") & F.col("old").isNull()
        known = known.withColumn("kind", F.when(fresh, "individual").otherwise(F.col("kind"))) if demote else known.where(~fresh)
    is_class = F.col("kind") == "class"
    match = cut(best_match(known.where(~is_class).select(F.col("name").alias("label")), catalog, "classes", CLASS_LEAST), "class-matches")
    own = F.concat(F.lit(TFL), T.slug(F.col("name")))
    m = known.join(match.select(F.col("label").alias("name"), F.col("iri").alias("mi"), F.col("match").alias("ml")), "name", "left")
    class_iri = F.when(is_class, own).otherwise(F.coalesce("mi", F.lit(TFL + "TransportEntity")))
    return m.select(F.concat(F.lit("ent_"), "n").alias("id"), "n", "name", "label", "comment", own.alias("iri"), class_iri.alias("class_iri"), F.when(is_class, F.col("label")).otherwise(F.coalesce("ml", F.lit("TransportEntity"))).alias("class_label"), is_class.alias("is_class"))


def map_edges(t: DataFrame, nodes: DataFrame, names: DataFrame, catalog: DataFrame) -> DataFrame:
    """Triplets whose ends are nodes (or a literal object), with the predicate's IRI; ``mapped`` says whether the catalog had it.

    The raw predicate is matched and gives the IRI; its label and kind are what ``names`` says, else itself and an object property.
    """
    s = nodes.select(F.col("name").alias("subject"), F.col("id").alias("subject_id"), F.col("iri").alias("subject_iri"))
    o = nodes.select(F.col("name").alias("object"), F.col("id").alias("object_id"), F.col("iri").alias("object_iri"))
    kinds = names.select(F.col("name").alias("predicate"), F.col("kind").alias("pk"), F.col("label").alias("pl"))
    # Predicates are few and each has very many triplets: what is known of one is written first, so that it goes to the triplets and not they to it.
    predicates = cut(t.select("predicate").distinct(), "predicates")
    match = best_match(predicates.withColumnRenamed("predicate", "label"), catalog, "predicates", PREDICATE_LEAST).select(F.col("label").alias("predicate"), F.col("iri").alias("mi"))
    known = cut(predicates.join(kinds, "predicate", "left").join(match, "predicate", "left"), "known-predicates")
    e = t.withColumn("lit", T.is_literal(F.col("object"))).join(s, "subject").join(o, "object", "left").where(F.col("lit") | F.col("object_id").isNotNull()).join(known, "predicate", "left")
    return e.select(
        "seq", "subject_id", "subject_iri", "predicate", F.coalesce("pl", "predicate").alias("predicate_label"), F.coalesce("mi", F.concat(F.lit(TFL), T.slug(F.col("predicate")))).alias("predicate_iri"),
        F.coalesce("pk", F.lit("object_property")).alias("predicate_kind"), "provenance_sentence",
        F.when(~F.col("lit"), F.col("object_id")).alias("object_id"), F.when(~F.col("lit"), F.col("object_iri")).alias("object_iri"),
        F.when(F.col("lit"), T.literal_lexical(F.col("object"))).alias("object_literal"), F.when(F.col("lit"), T.literal_iri(F.col("object"))).alias("object_datatype"), F.col("mi").isNotNull().alias("mapped"),
    )


def unmapped_predicates(edges: DataFrame) -> DataFrame:
    """Distinct raw predicates the catalog lacks, ascending."""
    return edges.where(~F.col("mapped")).select("predicate").distinct().orderBy("predicate")


def triples_of(spark: SparkSession, rows: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame([(*r, False, "") for r in rows], TRIPLES)


def construct(nodes: DataFrame, edges: DataFrame, owl_axioms: bool = False, catalog: DataFrame | None = None) -> DataFrame:
    """Header, classes, individuals, properties, relations and provenance as triples, repeats included; statements are numbered from 1 over the edges."""
    spark = nodes.sparkSession
    row = lambda s, p, o, lit=False, dt="": [s.alias("s"), F.lit(p).alias("p") if isinstance(p, str) else p.alias("p"), o.alias("o"), F.lit(lit).alias("is_literal"), F.lit(dt).alias("datatype") if isinstance(dt, str) else dt.alias("datatype")]
    ext = "http://example.org/tfl/extracted"
    parts = [triples_of(spark, [(ext, RDF_TYPE, OWL + "Ontology"), (ext, OWL + "imports", "http://example.org/tfl")])]
    first = cut(nodes.groupBy("class_iri").agg(F.min_by(F.struct("class_label", "comment", "is_class"), "n").alias("f")).select("class_iri", "f.*"), "classes")
    c = F.col("class_iri")
    parts += [
        first.select(*row(c, RDF_TYPE, F.lit(OWL + "Class"))),
        first.select(*row(c, RDFS + "label", F.col("class_label"), True, XSD + "string")),
        first.where("is_class AND comment <> ''").select(*row(c, RDFS + "comment", F.col("comment"), True, XSD + "string")),
    ]
    ind, i = nodes.where(~F.col("is_class")), F.col("iri")
    parts += [
        ind.select(*row(i, RDF_TYPE, F.lit(OWL + "NamedIndividual"))),
        ind.select(*row(i, RDF_TYPE, c)),
        ind.select(*row(i, RDFS + "label", F.col("label"), True, XSD + "string")),
        ind.where("comment <> ''").select(*row(i, RDFS + "comment", F.col("comment"), True, XSD + "string")),
    ]
    props = cut(edges.groupBy("predicate_iri").agg(F.min_by(F.struct("predicate_label", "predicate_kind"), "seq").alias("f")).select("predicate_iri", "f.*"), "properties")
    kind = F.when(F.col("predicate_kind") == "datatype_property", OWL + "DatatypeProperty").otherwise(OWL + "ObjectProperty")
    p = F.col("predicate_iri")
    parts += [props.select(*row(p, RDF_TYPE, kind)), props.select(*row(p, RDFS + "label", F.col("predicate_label"), True, XSD + "string"))]
    if catalog is not None:  # J12: the comment of the entry whose name is the label, or of the first whose label is
        named = catalog.groupBy(F.col("name").alias("predicate_label")).agg(F.max_by("comment", "base_category").alias("by_name"))
        labelled = catalog.groupBy(F.col("label").alias("predicate_label")).agg(F.min_by("comment", F.struct("base_category", "name")).alias("by_label"))
        note = F.coalesce(F.nullif("by_name", F.lit("")), F.nullif("by_label", F.lit("")))
        noted = props.join(named, "predicate_label", "left").join(labelled, "predicate_label", "left").withColumn("note", note).where("note IS NOT NULL")
        parts.append(noted.select(*row(p, RDFS + "comment", F.col("note"), True, XSD + "string")))
        if owl_axioms:
            for flag, axiom in (("symmetric", "SymmetricProperty"), ("transitive", "TransitiveProperty"), ("functional", "FunctionalProperty")):
                marked = catalog.where(F.col(flag)).select(F.col("label").alias("predicate_label")).distinct()
                parts.append(props.join(marked, "predicate_label").select(*row(p, RDF_TYPE, F.lit(OWL + axiom))))
    s = F.col("subject_iri")
    parts += [
        edges.where("object_iri IS NOT NULL").select(*row(s, p, F.col("object_iri"))),
        edges.where("object_literal IS NOT NULL").select(*row(s, p, F.col("object_literal"), True, F.col("object_datatype"))),
        ranked(edges.select("seq", "provenance_sentence"), "seq").where("coalesce(provenance_sentence, '') <> ''").select(*row(F.concat(F.lit(PT + "stmt/"), F.col("rank")), PROV + "value", F.col("provenance_sentence"), True, XSD + "string")),
    ]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def to_graph(triples: DataFrame) -> DataFrame:
    """K1, U4: the set of complete triples with term kinds."""
    full = triples.where("coalesce(s, '') <> '' AND coalesce(p, '') <> '' AND coalesce(o, '') <> ''")
    return full.select("s", "p", "o", F.when(F.col("is_literal"), "literal").when(F.col("o").startswith("_:"), "bnode").otherwise("iri").alias("o_kind"), F.coalesce("datatype", F.lit("")).alias("datatype"), F.lit("").alias("lang")).distinct()


#: Triples that meet in a task when what is new is told from what was there.
TASK_TRIPLES = 500_000


def reason(triples: DataFrame, rules: tuple = RULES) -> DataFrame:
    """What one pass over the triples adds: connected entities, inverse and symmetric relations.

    Literal rows and rows with an empty part take no part.
    """
    base = triples.where("NOT is_literal AND coalesce(s, '') <> '' AND coalesce(p, '') <> '' AND coalesce(o, '') <> ''")
    table = triples.sparkSession.createDataFrame([(p, q) for _, p, q in rules], "p string, q string")
    typed = base.where(F.col("p") != RDF_TYPE).select("s", F.lit(RDF_TYPE).alias("p"), F.lit(CONNECTED).alias("o"))
    swapped = base.join(F.broadcast(table), "p").select(F.col("o").alias("s"), F.col("q").alias("p"), F.col("s").alias("o"))  # rules, not data
    # Inferred and given triples are told apart in one exchange, by parts that follow the rows; only given ones that could be inferred count.
    given = base.where("datatype = ''").join(F.broadcast(table.select(F.col("q").alias("p")).union(triples.sparkSession.range(1).select(F.lit(RDF_TYPE))).distinct()), "p", "left_semi")
    parts = max(int(triples.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-base.count() // TASK_TRIPLES))
    both = typed.unionByName(swapped).withColumn("old", F.lit(False)).unionByName(given.select("s", "p", "o", F.lit(True).alias("old")))
    fresh = both.repartition(parts, "s", "p", "o").groupBy("s", "p", "o").agg(F.bool_or("old").alias("old")).where("NOT old")
    return fresh.select("s", "p", "o", F.lit(False).alias("is_literal"), F.lit("").alias("datatype"))


def owl_closure(graph: DataFrame) -> DataFrame:
    """The graph with subclass and subproperty closure, equivalences, inverses, symmetry, chains of two, transitivity, and domain and range types.

    Unions as domain or range (blank nodes) give no type. Full description-logic reasoning is out of scope.
    """
    g = cut(graph.select("s", "p", "o", "o_kind", "datatype", "lang"), "owl")
    # Axioms are written apart: they are few, and so go to the facts, which are not dealt by predicate or class.
    told = [RDFS + x for x in ("subClassOf", "subPropertyOf", "domain", "range")] + [OWL + x for x in ("equivalentClass", "equivalentProperty", "inverseOf", "propertyChainAxiom")]
    axioms = cut(g.where(F.col("p").isin(told) | F.col("p").endswith("#first") | F.col("p").endswith("#rest") | ((F.col("p") == RDF_TYPE) & F.col("o").startswith(OWL))).distinct(), "owl-axioms")
    iri = lambda df: df.select("s", "p", "o", F.lit("iri").alias("o_kind"), F.lit("").alias("datatype"), F.lit("").alias("lang"))
    of = lambda p: axioms.where((F.col("p") == p) & (F.col("o_kind") == "iri")).select(F.col("s").alias("src"), F.col("o").alias("dst"))
    both = lambda e: e.union(e.select("dst", "src"))
    sub = transitive_closure(of(RDFS + "subClassOf").union(both(of(OWL + "equivalentClass"))))
    subp = transitive_closure(of(RDFS + "subPropertyOf").union(both(of(OWL + "equivalentProperty")))).where("src <> dst")
    # Repeats are harmless until the end, where one exchange drops them.
    facts = g.join(subp, g["p"] == subp["src"]).select("s", F.col("dst").alias("p"), "o", "o_kind", "datatype", "lang").union(g)
    links = facts.where("o_kind <> 'literal'")
    inverse = cut(both(of(OWL + "inverseOf")).distinct(), "owl-inverse")
    inv = links.join(inverse, links["p"] == inverse["src"]).select(F.col("o").alias("s"), F.col("dst").alias("p"), F.col("s").alias("o"))
    kind = lambda k: axioms.where((F.col("p") == RDF_TYPE) & (F.col("o") == OWL + k)).select(F.col("s").alias("p")).distinct()
    sym = links.join(kind("SymmetricProperty"), "p").select(F.col("o").alias("s"), "p", F.col("s").alias("o"))
    links = iri(inv).union(iri(sym)).union(links)
    lists = axioms.where(F.col("p") == OWL + "propertyChainAxiom").select(F.col("s").alias("q"), F.col("o").alias("l1"))
    nxt = axioms.where(F.col("p").endswith("#first")).select(F.col("s").alias("l"), F.col("o").alias("f"))
    rest = axioms.where(F.col("p").endswith("#rest")).select(F.col("s").alias("l"), F.col("o").alias("r"))
    two = cut(lists.join(nxt.withColumnsRenamed({"l": "l1", "f": "p1"}), "l1").join(rest.withColumnsRenamed({"l": "l1", "r": "l2"}), "l1").join(nxt.withColumnsRenamed({"l": "l2", "f": "p2"}), "l2").select("q", "p1", "p2").distinct(), "owl-chains")
    x = links.select(F.col("s").alias("a"), F.col("p").alias("p1"), F.col("o").alias("m")).join(two, "p1").distinct()
    y = links.select(F.col("s").alias("m"), F.col("p").alias("p2"), F.col("o").alias("b")).join(two.select("p2"), "p2", "left_semi").distinct()
    chained = cut(x.join(y, ["m", "p2"]).select(F.col("a").alias("s"), F.col("q").alias("p"), F.col("b").alias("o")).distinct(), "owl-chained")
    links = iri(chained).union(links)
    trans = links.join(kind("TransitiveProperty"), "p")
    ends = transitive_closure(trans.select(F.struct("p", F.col("s").alias("x")).alias("src"), F.struct("p", F.col("o").alias("x")).alias("dst")))
    links = iri(ends.select(F.col("src.x").alias("s"), F.col("src.p").alias("p"), F.col("dst.x").alias("o"))).union(links)
    facts = facts.where("o_kind = 'literal'").union(links)
    dom, ran = of(RDFS + "domain"), of(RDFS + "range")
    typed = facts.join(dom, facts["p"] == dom["src"]).select("s", F.lit(RDF_TYPE).alias("p"), F.col("dst").alias("o"))
    typed = typed.union(links.join(ran, links["p"] == ran["src"]).select(F.col("o").alias("s"), F.lit(RDF_TYPE).alias("p"), F.col("dst").alias("o")).where(~F.col("o").startswith(XSD)))
    typed = cut(iri(typed).union(facts.where(F.col("p") == RDF_TYPE)).distinct(), "owl-typed")
    up = typed.join(sub, typed["o"] == sub["src"]).select("s", "p", F.col("dst").alias("o"))
    supers = iri(sub.where("src <> dst").select(F.col("src").alias("s"), F.lit(RDFS + "subClassOf").alias("p"), F.col("dst").alias("o")))
    return facts.union(typed).union(iri(up)).union(supers).distinct()


def functional_violations(graph: DataFrame, functional: DataFrame | None = None) -> DataFrame:
    """``(s, p, n)`` where a functional property has several values. ``functional``: p; else the graph's own declarations.

    Properties are schema, not data: they go to the triples, as one property's triples may be nearly all.
    """
    f = functional if functional is not None else graph.where((F.col("p") == RDF_TYPE) & (F.col("o") == OWL + "FunctionalProperty")).select(F.col("s").alias("p"))
    return graph.join(F.broadcast(f.distinct()), "p").groupBy("s", "p").agg(F.count_distinct("o").alias("n")).where("n > 1")


def disjoint_violations(types: DataFrame, disjoint: DataFrame) -> DataFrame:
    """``(s, a, b)`` with both classes of a disjoint pair. ``types``: s, o; ``disjoint``: a, b."""
    x, y = types.select("s", F.col("o").alias("a")), types.select("s", F.col("o").alias("b"))
    return x.join(disjoint, "a").join(y, ["s", "b"]).select("s", "a", "b").distinct()


def report(triples: DataFrame, unmapped: int = 0, conflicts: int = 0) -> DataFrame:
    """The validation counters in one row; a bad subject or predicate counts once."""
    bad = ~T.is_iri(F.col("s")) | ~T.is_iri(F.col("p")) | (~F.col("is_literal") & ~T.is_iri(F.col("o")))
    return triples.agg(
        F.count(F.lit(1)).alias("triple_count"), F.coalesce(F.bool_or(F.col("p") != RDF_TYPE), F.lit(False)).alias("has_relation"), F.count_if(F.coalesce(bad, F.lit(True))).alias("iri_errors"),
        F.lit(unmapped).cast("long").alias("unmapped_predicates"), F.lit(conflicts).cast("long").alias("linking_conflicts"),
    )


def validate(triples: DataFrame, iteration: int = 0, unmapped: int = 0, conflicts: int = 0) -> dict:
    """Counters, errors in fixed order, and where to go back to."""
    r = report(triples, unmapped, conflicts).first().asDict()
    errors = [] if r["triple_count"] else ["Ontology contains no triples."]
    errors += [] if r["has_relation"] else ["No object/data relations found."]
    errors += [f"IRI validation failed for {r['iri_errors']} triples."] if r["iri_errors"] else []
    errors += [f"Linking consistency conflicts detected: {conflicts}"] if conflicts > 0 else []
    target = "end" if not errors else "entity_linking" if conflicts > 0 else "extraction" if not r["has_relation"] else "end"
    return {"report": r, "errors": errors, "failed": bool(errors), "missing_relations": not r["has_relation"], "reroute_target": target, "iteration": iteration + 1}


def route(iteration: int = 0, failed: bool = False, target: str | None = None, missing_relations: bool = False, low_confidence: bool = False) -> str:
    """The next stage after validation."""
    if iteration >= 2:
        return "end"
    if target:
        return target
    if missing_relations:
        return "extraction"
    if low_confidence:
        return "coreference_resolution"
    return "entity_linking" if failed else "end"


def extract_ontology(graph: DataFrame) -> DataFrame:
    """``(base_category, kind, label, iri)`` of classes, individuals and properties with IRIs; a later kind takes an equal label."""
    lab = graph.where(F.col("p") == RDFS + "label").groupBy("s").agg(F.min("o").alias("rl"))
    types = graph.where((F.col("p") == RDF_TYPE) & ~F.col("s").startswith("_:")).select("s", "o").distinct()
    classes = types.where(F.col("o") == OWL + "Class").select(F.col("s").alias("o"))
    kinds = [("entities", "class", 0, types.where(F.col("o") == OWL + "Class")), ("entities", "individual", 1, types.where(F.col("o") == OWL + "NamedIndividual")), ("entities", "individual", 2, types.join(classes, "o")),
             ("relations", "object_property", 0, types.where(F.col("o") == OWL + "ObjectProperty")), ("relations", "datatype_property", 1, types.where(F.col("o") == OWL + "DatatypeProperty"))]
    out = None
    for base, kind, phase, df in kinds:
        part = df.select("s", F.lit(base).alias("base_category"), F.lit(kind).alias("kind"), F.lit(phase).alias("phase"))
        out = part if out is None else out.union(part)
    named = out.join(lab, "s", "left").withColumn("label", F.coalesce("rl", T.local_name(F.col("s"))))
    best = named.groupBy("base_category", "label").agg(F.max_by(F.struct("kind", "s"), F.struct("phase", "s")).alias("x"))
    return best.select("base_category", F.col("x.kind").alias("kind"), "label", F.col("x.s").alias("iri"))


def upsert_catalog(catalog: DataFrame, seen: DataFrame) -> DataFrame:
    """K8: entries by (role, iri): the last label stays, the first place stays. ``seen``: ord, role, label, iri, later than the catalog."""
    label = F.when(F.coalesce("label", F.lit("")) == "", T.iri_label(F.col("iri"))).otherwise(F.col("label"))
    both = catalog.withColumn("age", F.lit(0)).unionByName(seen.withColumn("age", F.lit(1))).withColumn("label", label)
    got = both.groupBy("role", "iri").agg(F.min(F.struct("age", "ord")).alias("f"), F.max_by("label", F.struct("age", "ord")).alias("label"))
    return ranked(got, "f", "role", "iri", name="ord").select("ord", "role", "label", "iri")


def append_catalog(catalog: DataFrame, seen: DataFrame) -> DataFrame:
    """K9: entries whose IRI the catalog lacks, repeats within ``seen`` included."""
    return catalog.unionByName(seen.join(catalog.select("role", "iri").distinct(), ["role", "iri"], "left_anti").select(*catalog.columns))


def zone_gaps(engine, most: int | None = 5) -> DataFrame:
    """Stations without a zone, at most ``most`` (null: all)."""
    text = f"""PREFIX : <{ZONE_NS}> PREFIX t: <{TFL}> PREFIX w: <http://webprotege.stanford.edu/>
    SELECT DISTINCT ?station ?name WHERE {{ {{ ?station a w:TrainStation }} UNION {{ ?station a t:Station }} {{ ?station rdfs:label ?name }} UNION {{ ?station :hasName ?name }}
    FILTER NOT EXISTS {{ ?station :hasZone ?z }} FILTER NOT EXISTS {{ ?station t:locatedInZone ?z }} }} ORDER BY ?station"""
    return engine.query(text + (f" LIMIT {most}" if most is not None else ""))


def complete_zones(predicted: DataFrame) -> DataFrame:
    """Graph rows for ``(station, answer)``: the first whole number of each answer as its zone, with type, number and label; no number, no rows."""
    number = F.col("n").cast("string")
    z = F.concat(F.lit(TFL + "Zone_"), number)
    p = predicted.withColumn("n", T.first_integer(F.col("answer"))).where("n IS NOT NULL")
    row = lambda s, pr, o, kind="iri", dt="": F.struct(s.alias("s"), F.lit(pr).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"), F.lit(dt).alias("datatype"), F.lit("").alias("lang"))
    rows = F.array(row(F.col("station"), ZONE_NS + "hasZone", z), row(z, RDF_TYPE, F.lit(ZONE_CLASS)), row(z, ZONE_NS + "zoneNumber", number, "literal", XSD + "integer"), row(z, RDFS + "label", F.concat(F.lit("Zone "), number), "literal", XSD + "string"))
    return p.select(F.explode(rows).alias("r")).select("r.*").distinct()
