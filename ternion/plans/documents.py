"""From documents to a validated graph: the stages of the survey in one lazy chain over all documents, or file by file.

In batch mode all documents pass each stage at once; names meet across documents, and nothing depends on their order.
In sequential mode files go one after another in the order of their paths, and each sees the catalog and the
canonical names that earlier ones left. Tables of the state stand in the output folder; a file whose digest is known
is not read again, its rows are taken from there.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ternion.functions import text as T
from ternion.operators import graph as G
from ternion.operators import linking as L
from ternion.operators import providers as P
from ternion.operators import triplets as TR
from ternion.plans import tbox
from ternion.plans.lineage import cut, ranked
from ternion.plans.shipping import ship
from ternion.plans.sparql import Engine, split_corpus
from ternion.plans.sparql.lower import tool_query
from ternion.schema import GRAPH, RDFS, SCHEMA_CATALOG, TRIPLES
from ternion.sources import files, sinks
from ternion.sources.graphs import PATTERNS, read_graph
from ternion.sources.structured import structured_triplets

CHUNK_WORDS, EXTRACT_WORDS, NEAREST = 350, 350, 3
KINDS = {"entities_class": "class", "entities_individual": "individual", "relations_object": "object_property", "relations_data": "datatype_property"}
EMBEDDINGS = "base_category string, name string, description string, vec array<double>"
CANONICAL = "category string, surface string, canonical string"
ANNOTATIONS = "base_category string, name string, kind string, label string, comment string, symmetric boolean, transitive boolean, functional boolean"


@dataclass
class State:
    """What outlives a run: learned catalog, embeddings, canonical names, annotations, file digests, triples."""

    catalog: DataFrame
    embeddings: DataFrame
    canonical: DataFrame
    annotations: DataFrame
    hashes: DataFrame
    triples: DataFrame

    TABLES = {"catalog": SCHEMA_CATALOG, "embeddings": EMBEDDINGS, "canonical": CANONICAL, "annotations": ANNOTATIONS, "hashes": files.STATE, "triples": TRIPLES + ", path string"}

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> State:
        """The tables of a folder, empty where there are none."""
        return cls(**{name: sinks.load_rows(spark, f"{folder}/state/{name}", schema) for name, schema in cls.TABLES.items()})

    def save(self, folder: str) -> State:
        """The tables written, and read again from there."""
        spark = self.catalog.sparkSession
        kept = {name: cut(getattr(self, name), f"state-{name}") for name in self.TABLES}  # nothing reads what is overwritten
        for name, df in kept.items():
            sinks.save_rows(df, f"{folder}/state/{name}")
        return State.load(spark, folder)


@dataclass
class Run:
    """A run's tables, by stage, and its report."""

    triplets: DataFrame
    names: DataFrame
    nodes: DataFrame
    edges: DataFrame
    triples: DataFrame
    stats: DataFrame
    report: dict
    fresh: dict[str, DataFrame] = field(default_factory=dict)
    timings: dict[str, float] = field(default_factory=dict)


def extract(docs: DataFrame, provider: P.ModelProvider, paraphrase: bool = False) -> DataFrame:
    """The merged triplets of documents ``(doc_id, text)``.

    Relations come from sentences, types from whole texts, listed triplets from chunks of words, in this order of rank.
    """
    clean = docs.select(F.col("doc_id").cast("string").alias("doc_id"), T.collapse(F.coalesce(F.col("text"), F.lit(""))).alias("text"))
    if paraphrase:
        chunks = clean.select("doc_id", F.posexplode(T.greedy_chunks(T.sentences(F.col("text"), True), CHUNK_WORDS)).alias("n", "text"))
        joined = P.paraphrased(chunks, provider).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("n", "text"))).alias("x"))
        new = joined.select("doc_id", F.array_join(F.transform("x", lambda s: s["text"]), " ").alias("new"))
        clean = clean.join(new, "doc_id", "left").select("doc_id", F.when(T.strip(F.coalesce("new", F.lit(""))) != "", F.col("new")).otherwise(F.col("text")).alias("text"))
    whole = cut(P.resolved(clean, provider), "doc-texts")
    sentences = whole.select("doc_id", F.posexplode(T.sentences(F.col("text"))).alias("seq", "text"))
    chunks = whole.select("doc_id", F.posexplode(T.greedy_chunks(T.sentences(F.col("text")), EXTRACT_WORDS)).alias("seq", "text"))
    cols = ["doc_id", "seq", "subject", "predicate", "object", "provenance_sentence"]
    parts = [P.relation_triplets(sentences, provider), P.entity_triplets(whole, provider), P.extracted_triplets(chunks, provider)]
    ranked = [p.select(*cols, F.lit(k).alias("rank")) for k, p in enumerate(parts)]
    return TR.merge_triplets(TR.keep_triplets(ranked[0].unionByName(ranked[1]).unionByName(ranked[2])))


def classify(t: DataFrame, state: State, provider: P.ModelProvider) -> tuple[DataFrame, DataFrame]:
    """The catalog of the triplets' names, and their embeddings.

    Names annotated before keep that, relations with literal objects excepted; the others are described, embedded, shown
    with their first uses and nearest annotated names, classified and annotated.
    """
    names = cut(TR.names(t), "doc-names")
    embeddings = cut(P.filled(names, state.embeddings, provider), "doc-embeddings")
    literal = TR.has_literal(t)
    key = ["base_category", "name"]
    old = state.annotations.join(names, key, "left_semi")
    fresh = names.join(state.annotations.select(*key), key, "left_anti")
    uses = TR.usage_examples(t).groupBy("name").agg(F.array_sort(F.collect_list(F.struct("n", "example"))).alias("x")).select("name", F.transform("x", lambda s: s["example"]).alias("usage"))
    pool = state.annotations.join(embeddings.unionByName(state.embeddings).dropDuplicates(key), key).select("base_category", "name", "kind", "vec")
    asked = fresh.join(embeddings, key, "left")
    near = None
    for base in ("entities", "relations"):
        own = lambda df: df.where(F.col("base_category") == base)  # noqa: B023, E731
        found = L.knn(own(asked).select("name", "vec"), own(pool), NEAREST).groupBy("name").agg(F.array_sort(F.collect_list(F.struct("rank", "near", "kind"))).alias("near")).select(F.lit(base).alias("base_category"), "name", "near")
        near = found if near is None else near.unionByName(found)
    shown = fresh.join(uses, "name", "left").join(near, key, "left").join(literal.select(F.lit("relations").alias("base_category"), F.col("predicate").alias("name"), "has_literal"), key, "left")
    new = P.annotated(TR.classify(P.classified(shown, provider), literal), provider)
    kept = TR.classify(old.select(*key, "kind", "symmetric", "transitive", "functional"), literal).join(old.select(*key, "label", "comment"), key)
    cols = [c.split()[0] for c in ANNOTATIONS.split(", ")]
    return cut(new.select(*cols).unionByName(kept.select(*cols)), "doc-catalog"), embeddings


def link(t: DataFrame, catalog: DataFrame, embeddings: DataFrame, state: State, provider: P.ModelProvider) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Triplets rewritten to canonical names, the names' map by category, the counts.

    The four categories are linked apart: surfaces are grouped, new names stand against each other and against the
    known canonical ones, clusters are judged, named, and prior names honoured.
    """
    kinds = TR.categories(catalog.select("base_category", "name", "kind"))
    # Linking tests the object alone for a literal, so a literal subject is an individual here.
    subjects = t.select(F.lit("entities").alias("base_category"), F.col("subject").alias("name")).distinct()
    extra = subjects.join(kinds, ["base_category", "name"], "left_anti").withColumn("kind", F.lit("individual"))
    groups = cut(L.surface_groups(TR.categories(extra.unionByName(kinds.select("base_category", "name", "kind"))), "category"), "doc-surfaces")
    vectors = embeddings.unionByName(state.embeddings).dropDuplicates(["base_category", "name"]).select(F.col("base_category").alias("_base"), "name", "vec")
    maps, stats = None, None
    for category, kind in KINDS.items():
        own = groups.where(F.col("category") == category)
        prior = state.canonical.where(F.col("category") == category)
        found = own.select(F.col("rep").alias("name")).distinct()
        new = L.new_names(found, prior.select(F.col("surface").alias("name")))
        universe = L.universe(new, prior.select(F.col("canonical").alias("name")))
        base = category.split("_")[0]
        items = cut(universe.join(vectors.where(F.col("_base") == base), "name", "left").select("name", "is_new", F.coalesce("vec", F.array().cast("array<double>")).alias("vec")), "doc-items")
        exact = items.limit(L.EXACT_UP_TO + 1).count() <= L.EXACT_UP_TO
        decisions = cut(L.decide(L.exact_pairs(items) if exact else L.blocked_pairs(items).drop("score")), "doc-decisions")
        members = cut(L.clusters(items, decisions), "doc-clusters")
        members = cut(L.disband(members, P.judged(members, provider, kind)), "doc-judged")
        marked = members.join(items.select("name", "is_new"), "name").join(prior.select(F.col("canonical").alias("name"), F.lit(True).alias("known")).distinct(), "name", "left").withColumn("known", F.coalesce("known", F.lit(False)))
        named = P.named(marked, provider).join(items.where("is_new").select("name"), "name", "left_semi").select("name", "canonical")
        resolved = own.select(F.col("name").alias("surface"), "rep").join(named.withColumnRenamed("name", "rep"), "rep", "left").join(prior.select(F.col("surface").alias("rep"), F.col("canonical").alias("pc")), "rep", "left")
        part = resolved.select(F.lit(category).alias("category"), "surface", "rep", F.coalesce("pc", "canonical", "rep").alias("canonical"))
        count = L.linking_stats(decisions, members, category, "exact" if exact else "hybrid")
        maps, stats = (part, count) if maps is None else (maps.unionByName(part), stats.unionByName(count))
    maps, stats = cut(maps, "doc-canonical"), cut(stats, "doc-linking")
    by = lambda base: maps.where(F.col("category").startswith(base)).select(F.col("surface").alias("name"), "canonical")
    return L.rewrite(t, by("entities"), by("relations")), maps, stats


def build(t: DataFrame, state: State, provider: P.ModelProvider, closed: bool = True) -> Run:
    """The stages behind extraction, with one loop back to linking where validation asks for it."""
    spark, clock = t.sparkSession, sinks.Timings()
    t = cut(t, "doc-triplets")
    with clock.stage("entity_classification"):
        catalog, embeddings = classify(t, state, provider)
    iteration, current = 0, t
    while True:
        with clock.stage("entity_linking"):
            linked, maps, stats = link(current, catalog, embeddings, state, provider)
            linked = cut(linked, "doc-linked")
        with clock.stage("schema_mapping"):
            found = G.schema_catalog(spark, state.catalog)
            names = catalog.groupBy("name").agg(F.max_by(F.struct("kind", "label", "comment"), "base_category").alias("x")).select("name", "x.*")
            numbered = linked.withColumn("seq", F.monotonically_increasing_id())
            numbered = cut(numbered, "doc-numbered")
            nodes = cut(G.map_nodes(numbered, names, found, closed), "doc-nodes")
            edges = cut(G.map_edges(numbered, nodes, names, found), "doc-edges")
        with clock.stage("ontology_construction"):
            draft = cut(G.construct(nodes, edges, catalog=catalog), "doc-draft")
        with clock.stage("reasoning"):
            triples = cut(draft.unionByName(G.reason(draft)), "doc-triples")
        with clock.stage("validation"):
            conflicts = stats.agg(F.coalesce(F.sum("conflicts"), F.lit(0)).alias("n")).first()["n"]
            report = G.validate(triples, iteration, G.unmapped_predicates(edges).count(), conflicts)
        iteration = report["iteration"]
        # Extraction and coreference give the same again here, so only linking is worth a second round.
        if G.route(iteration, report["failed"], report["reroute_target"], report["missing_relations"]) != "entity_linking":
            break
        current = linked
    fresh = {"embeddings": embeddings, "annotations": catalog, "canonical": maps.select("category", F.col("rep").alias("surface"), "canonical").distinct()}
    return Run(linked, catalog, nodes, edges, triples, stats, report, fresh, clock.seconds)


def learned(state: State, run: Run, paths: DataFrame | None = None) -> State:
    """The state with what a run found: catalog entries, embeddings, annotations, canonical names, digests, triples."""
    seen = run.nodes.select(F.col("n").alias("ord"), F.lit("classes").alias("role"), F.col("class_label").alias("label"), F.col("class_iri").alias("iri"))
    seen = seen.unionByName(run.edges.select(F.col("seq").alias("ord"), F.lit("predicates").alias("role"), F.col("predicate_label").alias("label"), F.col("predicate_iri").alias("iri")))
    later = lambda old, new, key: old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new.select(*old.columns))
    canonical = run.fresh["canonical"].join(state.canonical.select("category", "surface"), ["category", "surface"], "left_anti")
    rows = run.triples.withColumn("path", F.lit(None).cast("string")) if paths is None else run.triples.crossJoin(F.broadcast(paths.select("path").limit(1)))  # one file
    hashes = state.hashes if paths is None else files.merged_state(state.hashes, paths)
    old = state.triples if paths is None else state.triples.join(paths.select("path"), "path", "left_anti").select(*state.triples.columns)
    return State(
        G.upsert_catalog(state.catalog, seen), later(state.embeddings, run.fresh["embeddings"], ["base_category", "name"]), state.canonical.unionByName(canonical.select(*state.canonical.columns)),
        later(state.annotations, run.fresh["annotations"], ["base_category", "name"]), hashes, old.unionByName(rows.select(*state.triples.columns)),
    )


def _document_triplets(docs: DataFrame, provider: P.ModelProvider, structured: bool) -> DataFrame:
    """Triplets of ``(path, text)``: structured dumps by their own reader where asked for, prose by extraction."""
    named = docs.select(F.col("path").alias("doc_id"), "text")
    if not structured:
        return extract(named, provider)
    dump = F.col("doc_id").rlike(r"\.(json|tsv)$") | T.strip(F.col("text")).rlike(r"^[\{\[]|^[^\n]*\t")
    found = TR.merge_triplets(TR.keep_triplets(structured_triplets(named.where(dump)).withColumn("rank", F.lit(0))))
    return extract(named.where(~dump), provider).unionByName(found)


def run_folder(spark: SparkSession, folder: str, out: str, provider: P.ModelProvider | None = None, patterns: str = "*.txt,*.json", mode: str = "batch", structured: bool = False, closed: bool = True) -> dict:
    """The files of a folder as one graph in ``out`` (``final``, ``run_summary.json``, ``state``); returns the summary.

    Unchanged files are replayed from the state. ``batch``: all changed files at once; ``sequential``: one by one.
    """
    ship(spark)
    provider = provider or P.LocalProvider()
    found = cut(files.scan_files(spark, folder, patterns), "doc-files")
    state = State.load(spark, out)
    changed = cut(files.changed_files(found, state.hashes), "doc-changed")
    paths = sorted(r["path"] for r in changed.select("path").collect())  # names of files that changed
    groups = [changed.where(F.col("path") == p) for p in paths] if mode == "sequential" else ([changed] if paths else [])
    runs, clock = [], sinks.Timings()
    for group in groups:
        with clock.stage("extraction"):
            t = cut(_document_triplets(group, provider, structured), "doc-extracted")
        run = build(t, state, provider, closed)
        single = group if mode == "sequential" else None
        state = learned(state, run, single)
        if single is None:
            state.hashes = files.merged_state(state.hashes, group)
        state = state.save(out)
        for name, s in run.timings.items():
            clock.seconds[name] = clock.seconds.get(name, 0.0) + s
        runs.append({"files": [r["path"] for r in group.select("path").collect()], "triplets": run.triplets.count(), "validated_triples": run.triples.count(), "validation_errors": run.report["errors"], "report": run.report["report"], "per_stage_timings": run.timings})
    graph = cut(G.to_graph(state.triples), "doc-graph")
    sinks.write_graph(graph, f"{out}/final")
    summary = {"timestamp": datetime.now(timezone.utc).isoformat(), "sources_processed": found.count(), "cache_hits": found.count() - len(paths), "runs": runs, "final_triples": graph.count(), "cumulative_timings": clock.seconds, "graph_path": f"{out}/final"}
    sinks.save_json(spark, f"{out}/run_summary.json", summary)
    sinks.save_json(spark, f"{out}/rag_catalog.json", {role: [{"label": r["label"], "iri": r["iri"]} for r in state.catalog.where(F.col("role") == role).orderBy("ord").select("label", "iri").collect()] for role in ("classes", "predicates")})  # the schema's entries
    return summary


def contexts(graph: DataFrame, entries: DataFrame) -> DataFrame:
    """Entries (base_category, kind, label, iri) with the context that the graph gives of them."""
    local = lambda c: T.local_name(F.col(c))
    first = lambda p, name: graph.where((F.col("p") == p) & (F.col("o_kind") == "iri")).groupBy(F.col("s").alias("iri")).agg(F.min(local("o")).alias(name))
    notes = graph.where(F.col("p") == RDFS + "comment").groupBy(F.col("s").alias("iri")).agg(F.min("o").alias("note"))
    parents = graph.where((F.col("p") == RDFS + "subClassOf") & (F.col("o_kind") == "iri")).groupBy(F.col("s").alias("iri")).agg(F.array_sort(F.collect_set(local("o"))).alias("parents"))
    named = entries.join(notes, "iri", "left").join(parents, "iri", "left").join(first(RDFS + "domain", "domain"), "iri", "left").join(first(RDFS + "range", "range"), "iri", "left")
    return named.select(*entries.columns, T.context(F.col("label"), F.col("note"), F.coalesce("parents", F.array().cast("array<string>")), F.col("domain"), F.col("range")).alias("context"))


def ingest_ontology(spark: SparkSession, folder: str, out: str, provider: P.ModelProvider | None = None, patterns: str = PATTERNS) -> dict:
    """Entry B: ontology files into the state: catalog, embeddings and protected canonical names; returns counts.

    Unchanged files are left out if the state has entries. A term with a context of eight words is described by it.
    """
    ship(spark)
    provider = provider or P.LocalProvider()
    state = State.load(spark, out)
    found = files.scan_files(spark, folder, patterns).select("path", "sha256")
    changed = cut(files.changed_files(found, state.hashes) if not state.embeddings.isEmpty() else found, "owl-changed")
    paths = [r["path"] for r in changed.select("path").collect()]  # names of files that changed
    if not paths:
        return {"files": 0, "classes": 0, "predicates": 0, "entries": 0}
    graph = cut(read_graph(spark, paths), "owl-graph")
    entries = cut(contexts(graph, G.extract_ontology(graph)), "owl-entries")
    asked = P.described(entries.select("base_category", "kind", F.col("label").alias("name"), "context"), provider)
    described = asked.withColumn("description", T.description_source(F.col("context"), F.col("description")))
    embeddings = cut(P.embedded(described, provider).select("base_category", "name", "description", "vec"), "owl-embeddings")
    role = F.when(F.col("base_category") == "entities", "classes").otherwise("predicates")
    seen = entries.select(F.lit(0).cast("long").alias("ord"), role.alias("role"), "label", "iri")
    catalog = G.append_catalog(state.catalog, seen)
    catalog = cut(ranked(catalog, "ord", "role", "iri", name="place").select(F.col("place").alias("ord"), "role", "label", "iri"), "owl-catalog")
    key = ["base_category", "name"]
    protected = TR.categories(entries).select("category", F.col("label").alias("surface"), F.col("label").alias("canonical"))
    before = state.catalog.groupBy("role").count().collect()
    after = catalog.groupBy("role").count().collect()
    n = {r["role"]: r["count"] - sum(b["count"] for b in before if b["role"] == r["role"]) for r in after}
    new = State(catalog, state.embeddings.join(embeddings, key, "left_anti").unionByName(embeddings), state.canonical.unionByName(protected.join(state.canonical, ["category", "surface"], "left_anti")), state.annotations, files.merged_state(state.hashes, changed), state.triples)
    new.save(out)
    return {"files": len(paths), "classes": n.get("classes", 0), "predicates": n.get("predicates", 0), "entries": entries.count()}


def answer_questions(engine: Engine, questions: list[dict], generate, out: str | None = None, system: str = "") -> dict:
    """Entry C, S11, K5, L14: each question through the agent; the records, and how many were answered."""
    import time

    def tool(name: str, parameters: dict) -> object:
        return tool_query(engine, parameters.get("query", ""), None) if name == "sparql_query" else {"error": f"Unknown tool: {name}"}

    records = []
    for q in questions:
        start = time.time()
        got = P.agent(q["question"], generate, tool, system)
        records.append({"id": q["id"], "question": q["question"], "expected": q.get("expected"), **got, "elapsed_s": round(time.time() - start, 2)})
    if out:
        sinks.save_json(engine.triples.sparkSession, out, records)
    return {"records": records, "answered": sum(bool(r["answer"]) for r in records)}


def evaluate(engine: Engine, corpus: str, out: str | None = None) -> str:
    """K6: every query of a corpus, counted and timed, as a report."""
    import resource
    import time

    start, rows = time.time(), []
    for title, text in split_corpus(corpus):
        begun = time.time()
        try:
            n: object = engine.query(text).count()
        except Exception as e:  # the report says what went wrong
            n = f"Error: {str(e).splitlines()[0]}"
        rows.append((title, n, time.time() - begun))
    report = sinks.evaluation_report(rows, time.time() - start, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024)
    if out:
        sinks.write_text(engine.triples.sparkSession, out, report)
    return report


ZONE_PROMPT = "What London Transport Zone is '{name}' located in? Answer with one whole number."


def complete(graph: DataFrame, provider: P.ModelProvider | None = None, out: str | None = None, most: int | None = 5) -> DataFrame:
    """The graph with predicted zones and the alignment of what the ontology lacks; ``out`` gets the graph and an analysis."""
    spark = graph.sparkSession
    ship(spark)
    gaps = cut(P.zone_answers(G.zone_gaps(Engine(graph), most), provider or P.LocalProvider()), "zones")
    aligned = spark.createDataFrame([(s, p, o, "iri", "", "") for s, p, o in tbox.COMPLETION], GRAPH)
    done = graph.select(*[c.split()[0] for c in GRAPH.split(", ")]).unionByName(G.complete_zones(gaps)).unionByName(aligned).distinct()
    if out:
        sinks.write_graph(done, f"{out}/final_completed")
        rows = gaps.withColumn("zone", T.first_integer(F.col("answer")).cast("string")).orderBy("station").limit(most if most is not None else 1000).collect()  # a report's rows
        sinks.write_text(spark, f"{out}/completion_analysis.md", sinks.completion_report([r.asDict() for r in rows], ZONE_PROMPT))
    return done
