"""The survey's operators over the relational tables, each with its SQL.

Triplets stand for facts of the tables: parts are made as types, customers are located in nations, orders have
priorities and opening days. Every query reads its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ternion.functions import text as T
from ternion.functions.similarity import cosine, jaccard
from ternion.operators import graph as G
from ternion.operators import linking as L
from ternion.operators import triplets as TR
from ternion.operators.closure import transitive_closure
from ternion.operators.components import connected_components
from ternion.plans.lineage import cut, ranked
from ternion.schema import CONNECTED, OWL, PROV, PT, RDF_TYPE, RDFS, SCHEMA_CATALOG, TFL, TRIPLES, XSD
from ternion.sources import files, sinks, structured, turtle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def query(sql: str | None) -> Callable:
    """Register the function under its name with its SQL."""

    def put(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return put


def _text(c: str) -> Column:
    return F.col(c).cast("string")


# ---- SQL pieces ----

_WORDS = "len(list_filter(string_split_regex(x, '\\s+'), lambda w: w <> ''))"
_SENTENCES = r"list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x, ' ' || chr(10) || chr(9) || chr(13))), lambda x: x <> '')"
_CAPITAL = _SENTENCES.replace(r"'([.!?])\s+', '\1' || chr(1)", r"'([.!?])\s+([A-Z])', '\1' || chr(1) || '\2'")
_MONTHS = T.MONTHS
_STOP = ", ".join(f"'{w}'" for w in T.STOP_WORDS)


def _is_literal(x: str) -> str:
    dates = " OR ".join(f"regexp_matches({x}, '{p}')" for p in T.DATES)
    return f"(regexp_full_match(trim({x}), '-?\\d+') OR regexp_full_match(trim({x}), '-?\\d+\\.\\d+') OR {dates})"


def _slug(x: str) -> str:
    return f"coalesce(nullif(regexp_replace(regexp_replace({x}, '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'item')"


def _surface(x: str) -> str:
    s = f"regexp_replace(lower(trim({x})), '^(the|a|an)\\s+', '')"
    s = f"trim(regexp_replace(regexp_replace({s}, '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
    return f"(SELECT CASE WHEN regexp_matches(z, '[^s]s$') AND length(z) > 3 THEN regexp_replace(z, 's$', '') ELSE z END FROM (SELECT {s} AS z))"


def _tokens(x: str) -> str:
    return f"list_distinct(list_filter(regexp_extract_all(lower({x}), '[a-z0-9]+'), lambda t: length(t) > 2 AND t NOT IN ({_STOP})))"


# ---- the triplets ----


def triplets(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, seq, rank, subject, predicate, object, provenance_sentence); some parts say a thing twice, in other letters."""
    part, customer, nation, orders = (table(spark, d, x) for x in ("part", "customer", "nation", "orders"))
    one = lambda df, doc, seq, rank, s, p, o: df.select(doc.cast("string").alias("doc_id"), seq.cast("long").alias("seq"), F.lit(rank).alias("rank"), s.alias("subject"), F.lit(p).alias("predicate"), o.alias("object"), F.concat_ws(" ", s, F.lit(p), o).alias("provenance_sentence"))
    key, order = F.col("p_partkey"), F.concat(F.lit("Order "), _text("o_orderkey"))
    lives = customer.join(F.broadcast(nation), customer["c_nationkey"] == nation["n_nationkey"])  # 25 nations
    parts = [
        one(part, key % 7, key * 4, 0, F.col("p_name"), "made as", F.col("p_type")),
        one(part, key % 7, key * 4 + 1, 0, F.col("p_name"), "has size", _text("p_size")),
        one(part, key % 7, key * 4 + 2, 1, F.upper("p_name"), "Made As", F.col("p_type")),
        one(lives, F.col("c_custkey") % 7, F.col("c_custkey") + 10**8, 0, F.col("c_name"), "located in", F.col("n_name")),
        one(orders, F.col("o_orderkey") % 7, F.col("o_orderkey") + 2 * 10**8, 2, order, "priority", F.col("o_orderpriority")),
        one(orders, F.col("o_orderkey") % 7, F.col("o_orderkey") + 3 * 10**8, 2, order, "opened", F.date_format("o_orderdate", "d MMMM yyyy")),
    ]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def _one(doc: str, seq: str, rank: int, s: str, p: str, o: str, source: str) -> str:
    return f"SELECT CAST({doc} AS VARCHAR) AS doc_id, CAST({seq} AS BIGINT) AS seq, {rank} AS rank, {s} AS subject, '{p}' AS predicate, {o} AS object, {s} || ' {p} ' || {o} AS provenance_sentence FROM {source}"


_T = "(" + " UNION ALL ".join([
    _one("p_partkey % 7", "p_partkey * 4", 0, "p_name", "made as", "p_type", "part"),
    _one("p_partkey % 7", "p_partkey * 4 + 1", 0, "p_name", "has size", "CAST(p_size AS VARCHAR)", "part"),
    _one("p_partkey % 7", "p_partkey * 4 + 2", 1, "upper(p_name)", "Made As", "p_type", "part"),
    _one("c_custkey % 7", "c_custkey + 100000000", 0, "c_name", "located in", "n_name", "customer JOIN nation ON c_nationkey = n_nationkey"),
    _one("o_orderkey % 7", "o_orderkey + 200000000", 2, "'Order ' || o_orderkey", "priority", "o_orderpriority", "orders"),
    _one("o_orderkey % 7", "o_orderkey + 300000000", 2, "'Order ' || o_orderkey", "opened", "strftime(o_orderdate, '%-d %B %Y')", "orders"),
]) + ")"


@query(f"SELECT seq, subject FROM {_T} WHERE length(trim(subject)) >= 2 AND trim(object) <> '' AND trim(predicate) <> ''")
def triplet_keep(spark: SparkSession, d: str) -> DataFrame:
    return TR.keep_triplets(triplets(spark, d), predicate_too=True).select("seq", "subject")


@query(f"SELECT doc_id, seq, subject, predicate, object FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(subject), lower(predicate), lower(object) ORDER BY rank, seq) AS rn FROM {_T}) WHERE rn = 1")
def triplet_dedup(spark: SparkSession, d: str) -> DataFrame:
    return TR.merge_triplets(triplets(spark, d)).select("doc_id", "seq", "subject", "predicate", "object")


@query(f"SELECT name, n, example FROM (SELECT name, row_number() OVER (PARTITION BY name ORDER BY seq, role) AS n, example FROM (SELECT subject AS name, 0 AS role, seq, '\"' || subject || '\" → ' || predicate || ' → \"' || object || '\"' AS example FROM {_T} UNION ALL SELECT object, 1, seq, '\"' || subject || '\" → ' || predicate || ' → \"' || object || '\"' FROM {_T})) WHERE n <= 3")
def usage_examples(spark: SparkSession, d: str) -> DataFrame:
    return TR.usage_examples(triplets(spark, d))


@query(f"SELECT predicate, bool_or({_is_literal('object')}) AS has_literal FROM {_T} GROUP BY predicate")
def has_literal(spark: SparkSession, d: str) -> DataFrame:
    return TR.has_literal(triplets(spark, d))


@query(f"SELECT 'entities' AS base_category, subject AS name FROM {_T} WHERE NOT {_is_literal('subject')} UNION SELECT 'entities', object FROM {_T} WHERE NOT {_is_literal('object')} UNION SELECT 'relations', predicate FROM {_T}")
def entity_names(spark: SparkSession, d: str) -> DataFrame:
    return TR.names(triplets(spark, d))


_LABELS = "['ORG', 'GPE', 'LOC', 'FAC', 'LAW', 'PRODUCT', 'EVENT', 'DATE', 'PERSON']"
_TYPES = "CASE label " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TR.ENTITY_TYPES.items()) + " END"


@query(f"SELECT doc_id, seq, surface, type FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(surface) ORDER BY seq) AS rn FROM (SELECT p_size % 9 AS doc_id, p_partkey AS seq, p_name AS surface, {_TYPES} AS type FROM (SELECT *, {_LABELS}[p_partkey % 9 + 1] AS label FROM part)) WHERE type IS NOT NULL AND length(trim(surface)) >= 3) WHERE rn = 1")
def entity_keep(spark: SparkSession, d: str) -> DataFrame:
    labels = F.array(*[F.lit(x) for x in ("ORG", "GPE", "LOC", "FAC", "LAW", "PRODUCT", "EVENT", "DATE", "PERSON")])
    found = table(spark, d, "part").select((F.col("p_size") % 9).alias("doc_id"), F.col("p_partkey").alias("seq"), F.col("p_name").alias("surface"), F.get(labels, (F.col("p_partkey") % 9).cast("int")).alias("label"))
    return TR.keep_entities(found).select("doc_id", "seq", "surface", "type")


# ---- catalogs of names ----

_KINDS = ("class", "individual", "nonsense", "object_property", "datatype_property")


def catalog(spark: SparkSession, d: str) -> DataFrame:
    """Customers as entities and parts as relations, their kinds by their numbers, some unknown or missing."""
    kind = lambda k: F.get(F.array(*[F.lit(x) for x in _KINDS]), (k % 6).cast("int"))
    flag = lambda k, n: F.when(k % n != 0, k % n == 1)
    made = lambda df, base, name, k: df.select(F.lit(base).alias("base_category"), name.alias("name"), kind(k).alias("kind"), F.upper(name).alias("label"), F.when(k % 3 == 0, F.concat(F.lit("about "), name)).otherwise("").alias("comment"), flag(k, 2).alias("symmetric"), flag(k, 3).alias("transitive"), flag(k, 5).alias("functional"))
    c, p = table(spark, d, "customer"), table(spark, d, "part")
    return made(c, "entities", F.col("c_name"), F.col("c_custkey")).unionByName(made(p, "relations", F.concat_ws(" ", "p_name", "p_partkey"), F.col("p_partkey")))


def _entries(base: str, name: str, k: str, source: str) -> str:
    flag = lambda n: f"CASE WHEN {k} % {n} <> 0 THEN {k} % {n} = 1 END"
    return f"SELECT '{base}' AS base_category, {name} AS name, [{', '.join(repr(x) for x in _KINDS)}][{k} % 6 + 1] AS kind, upper({name}) AS label, CASE WHEN {k} % 3 = 0 THEN 'about ' || {name} ELSE '' END AS comment, {flag(2)} AS \"symmetric\", {flag(3)} AS transitive, {flag(5)} AS functional FROM {source}"


_C = f"({_entries('entities', 'c_name', 'c_custkey', 'customer')} UNION ALL {_entries('relations', chr(39).join(['p_name || ', ' ', ' || p_partkey']), 'p_partkey', 'part')})"


@query(f"SELECT count(*) FILTER (kind = 'class') AS classes, count(*) FILTER (kind = 'individual') AS individuals, count(*) FILTER (kind = 'object_property') AS object_properties, count(*) FILTER (kind = 'datatype_property') AS datatype_properties, count(*) FILTER (coalesce(\"symmetric\", false)) AS \"symmetric\", count(*) FILTER (coalesce(transitive, false)) AS transitive, count(*) FILTER (coalesce(functional, false)) AS functional FROM {_C}")
def kind_counts(spark: SparkSession, d: str) -> DataFrame:
    return TR.kind_counts(catalog(spark, d))


_DATA = "(base_category = 'relations' AND length(name) % 2 = 0)"


@query(f"SELECT name, CASE WHEN base_category = 'entities' THEN CASE WHEN kind IN ('class', 'individual') THEN kind ELSE 'individual' END WHEN {_DATA} THEN 'datatype_property' WHEN kind IN ('object_property', 'datatype_property') THEN kind ELSE 'object_property' END AS kind, coalesce(\"symmetric\", false) AND NOT {_DATA} AS \"symmetric\", coalesce(transitive, false) AND NOT {_DATA} AS transitive, coalesce(functional, false) AND NOT {_DATA} AS functional FROM {_C}")
def classify(spark: SparkSession, d: str) -> DataFrame:
    c = catalog(spark, d)
    marks = c.where("base_category = 'relations'").select(F.col("name").alias("predicate"), (F.char_length("name") % 2 == 0).alias("has_literal"))
    return TR.classify(c, marks).select("name", "kind", "symmetric", "transitive", "functional")


@query(f"SELECT CASE WHEN base_category = 'relations' THEN CASE WHEN kind = 'datatype_property' THEN 'relations_data' ELSE 'relations_object' END WHEN kind = 'class' THEN 'entities_class' ELSE 'entities_individual' END AS category, count(*) AS n FROM {_C} GROUP BY 1")
def kind_categories(spark: SparkSession, d: str) -> DataFrame:
    return TR.categories(catalog(spark, d)).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


# ---- scalar functions ----


@query("SELECT p_partkey, trim(regexp_replace(lower(p_type || '  ' || p_name || ' '), '\\s+', ' ', 'g')) AS norm, " + _surface("'The ' || p_name || '!s  ' || p_type || 's'") + " AS surface, lower(trim(regexp_replace(replace(p_name, ' ', 'ToThe'), '([A-Z])', ' \\1', 'g'))) AS camel, CAST(nullif(regexp_extract(p_brand, '(\\d+)', 1), '') AS BIGINT) AS number, substring(repeat(p_name || '-', 40), 1, 200) AS provenance, 'x ' || p_name AS stripped FROM part")
def name_scalars(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(
        "p_partkey", T.label_norm(F.concat("p_type", F.lit("  "), "p_name", F.lit(" "))).alias("norm"), T.surface_norm(F.concat(F.lit("The "), "p_name", F.lit("!s  "), "p_type", F.lit("s"))).alias("surface"),
        T.camel_label(F.replace("p_name", F.lit(" "), F.lit("ToThe"))).alias("camel"), T.first_integer(F.col("p_brand")).alias("number"), T.provenance(F.repeat(F.concat("p_name", F.lit("-")), 40)).alias("provenance"),
        T.strip_special(F.concat(F.lit("<s>x "), "p_name", F.lit("</s>"))).alias("stripped"),
    )


_IRIS = "CASE p_partkey % 4 WHEN 0 THEN 'http://e.org/a#' || replace(p_name, ' ', '_') WHEN 1 THEN 'https://e.org/b/' || replace(p_name, ' ', '-') WHEN 2 THEN 'http://e.org/c#' ELSE p_name END"


@query(f"SELECT p_partkey, CASE WHEN t = '' THEN x ELSE t END AS local, replace(string_split(string_split(x, '#')[-1], '/')[-1], '_', ' ') AS label, starts_with(x, 'http://') OR starts_with(x, 'https://') AS is_iri FROM (SELECT p_partkey, x, trim(regexp_replace(string_split(string_split(x, '#')[-1], '/')[-1], '[_-]+', ' ', 'g')) AS t FROM (SELECT p_partkey, {_IRIS} AS x FROM part))")
def iri_scalars(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey") % 4
    x = F.when(k == 0, F.concat(F.lit("http://e.org/a#"), F.replace("p_name", F.lit(" "), F.lit("_")))).when(k == 1, F.concat(F.lit("https://e.org/b/"), F.replace("p_name", F.lit(" "), F.lit("-")))).when(k == 2, F.lit("http://e.org/c#")).otherwise(F.col("p_name"))
    return table(spark, d, "part").select("p_partkey", T.local_name(x).alias("local"), T.iri_label(x).alias("label"), T.is_iri(x).alias("is_iri"))


_FORMS = ["strftime(o_orderdate, '%-d %B %Y')", "'since ' || strftime(o_orderdate, '%B %-d, %Y')", "strftime(o_orderdate, '%b %Y')", "strftime(o_orderdate, '%-d/%-m/%y') || ' or so'", "'Late-' || strftime(o_orderdate, '%Y') || 's'", "strftime(o_orderdate, '%Y') || 's trains'", "strftime(o_orderdate, '%Y-%m-%d')", "' -' || o_orderkey || ' '", "CAST(o_custkey AS VARCHAR) || '.50'", "'+' || o_orderkey", "o_orderpriority"]


@query(f"SELECT o_orderkey, form, {_is_literal('x')} AS is_literal, CASE WHEN regexp_full_match(trim(x), '-?\\d+') THEN 'xsd:integer' WHEN regexp_full_match(trim(x), '-?\\d+\\.\\d+') THEN 'xsd:decimal' ELSE 'xsd:string' END AS datatype, CASE WHEN regexp_full_match(trim(x), '-?\\d+(\\.\\d+)?') THEN trim(x) ELSE x END AS lexical FROM (SELECT o_orderkey, CAST(unnest(range({len(_FORMS)})) AS INTEGER) AS form, unnest([{', '.join(_FORMS)}]) AS x FROM orders)")
def literal_detect(spark: SparkSession, d: str) -> DataFrame:
    day = lambda p: F.date_format("o_orderdate", p)
    key = _text("o_orderkey")
    forms = F.array(day("d MMMM yyyy"), F.concat(F.lit("since "), day("MMMM d, yyyy")), day("MMM yyyy"), F.concat(day("d/M/yy"), F.lit(" or so")), F.concat(F.lit("Late-"), day("yyyy"), F.lit("s")), F.concat(day("yyyy"), F.lit("s trains")), day("yyyy-MM-dd"), F.concat(F.lit(" -"), key, F.lit(" ")), F.concat(_text("o_custkey"), F.lit(".50")), F.concat(F.lit("+"), key), F.col("o_orderpriority"))
    x = F.col("x")
    return table(spark, d, "orders").select("o_orderkey", F.posexplode(forms).alias("form", "x")).select("o_orderkey", "form", T.is_literal(x).alias("is_literal"), T.literal_datatype(x).alias("datatype"), T.literal_lexical(x).alias("lexical"))


@query("SELECT p_partkey, unnest([p_name, p_name]) AS subject, unnest(['made as', 'worn with']) AS predicate, unnest([p_type, p_brand || ' too']) AS object FROM part")
def linearised_triplets(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit("<s><triplet> "), "p_name", F.lit(" <subj> "), "p_type", F.lit(" <obj> made as <triplet> lost <subj> end <triplet> "), "p_name", F.lit(" <subj> "), "p_brand", F.lit(" <obj> worn <subj> too <obj> with</s>"))
    return table(spark, d, "part").select("p_partkey", F.explode(T.linearised_triplets(text)).alias("t")).select("p_partkey", "t.*")


@query("SELECT s_suppkey, context, CASE WHEN len(list_filter(string_split_regex(context, '\\s+'), lambda w: w <> '')) >= 8 THEN context ELSE 'described' END AS source FROM (SELECT s_suppkey, concat_ws('; ', s_name, CASE WHEN s_suppkey % 3 = 0 THEN 'a supplier of note' END, CASE WHEN s_suppkey % 2 = 0 THEN 'subclass of Agent' END, 'subclass of Thing', CASE WHEN s_suppkey % 5 = 0 THEN 'domain Trade' END, 'range Place') AS context FROM supplier)")
def context_strings(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    parents = F.array_compact(F.array(F.when(k % 2 == 0, F.lit("Agent")), F.lit("Thing")))
    c = T.context(F.col("s_name"), F.when(k % 3 == 0, F.lit("a supplier of note")), parents, F.when(k % 5 == 0, F.lit("Trade")), F.lit("Place"))
    return table(spark, d, "supplier").select("s_suppkey", c.alias("context")).select("s_suppkey", "context", T.description_source(F.col("context"), F.lit("described")).alias("source"))


@query("SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 9) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def cosine_neighbours(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(nxt, "vec_id").select("vec_id", F.round(cosine(F.col("embedding"), F.col("other")), 9).alias("cosine"))


@query(f"SELECT p_partkey, CASE WHEN len(list_distinct(list_concat(a, b))) > 0 THEN len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) ELSE 0.0 END AS jaccard FROM (SELECT p_partkey, {_tokens('p_name')} AS a, {_tokens(chr(39).join(['p_type || ', ' red the small ', ' || p_size']))} AS b FROM part)")
def token_jaccard(spark: SparkSession, d: str) -> DataFrame:
    other = F.concat(F.col("p_type"), F.lit(" red the small "), _text("p_size"))
    return table(spark, d, "part").select("p_partkey", jaccard(T.block_tokens(F.col("p_name")), T.block_tokens(other)).alias("jaccard"))


# ---- chunks ----


def _chunked(sentences: str, limit: int) -> str:
    """Greedy chunks by a recursion over the sentences of all documents at once."""
    return f"""WITH RECURSIVE p AS (SELECT doc_id, unnest(range(len(s))) AS i, unnest(s) AS x FROM (SELECT row_number() OVER () AS row, doc_id, {sentences} AS s FROM documents)),
      c AS (SELECT doc_id, i, x, {_WORDS} AS w FROM p),
      r AS (SELECT doc_id, i, x, w AS n, 0 AS k FROM c WHERE i = 0
        UNION ALL SELECT c.doc_id, c.i, c.x, CASE WHEN r.n + c.w > {limit} AND r.n > 0 THEN c.w ELSE r.n + c.w END, r.k + CASE WHEN r.n + c.w > {limit} AND r.n > 0 THEN 1 ELSE 0 END FROM r JOIN c ON c.doc_id = r.doc_id AND c.i = r.i + 1)
    """


@query(_chunked(_SENTENCES, 350) + "SELECT doc_id, CAST(k AS INTEGER) AS n, string_agg(x, ' ' ORDER BY i) AS chunk FROM r GROUP BY doc_id, k")
def text_chunks_words(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.posexplode(T.greedy_chunks(T.sentences(F.col("text")), 350)).alias("n", "chunk"))


@query(_chunked(_CAPITAL, 120) + "SELECT doc_id, CAST(k AS INTEGER) AS n, string_agg(x, ' ' ORDER BY i) AS chunk FROM r GROUP BY doc_id, k")
def text_chunks_sentences(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.posexplode(T.greedy_chunks(T.sentences(F.col("text"), True), 120)).alias("n", "chunk"))


@query(f"SELECT doc_id, CAST(unnest(range(len(s))) AS INTEGER) AS n, unnest(s) AS sentence FROM (SELECT doc_id, {_CAPITAL} AS s FROM documents)")
def text_sentences_cap(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.posexplode(T.sentences(F.col("text"), True)).alias("n", "sentence"))


@query(f"SELECT doc_id, CASE WHEN {_WORDS.replace('(x,', '(text,')} <= 200 THEN text WHEN s = [] THEN text ELSE array_to_string(s, ' ') END AS text FROM (SELECT doc_id, text, {_CAPITAL} AS s FROM documents)")
def text_preprocessed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.preprocess(F.col("text"), 200).alias("text"))


@query("SELECT DISTINCT doc_id, mention FROM (SELECT doc_id, unnest(regexp_extract_all(regexp_replace(text, '[^\\x00-\\x7F]', '_', 'g'), '\\b[A-Z][a-zA-Z]+(?:\\s+[A-Z][a-zA-Z]+)*\\b')) AS mention FROM documents)")
def text_mentions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.explode(T.mentions(F.col("text"))).alias("mention"))


# ---- linking ----


@query(f"SELECT name, first_value(name) OVER (PARTITION BY {_surface('name')} ORDER BY regexp_matches(name, '^[A-Z]') DESC, length(regexp_replace(name, '[^A-Z]', '', 'g')) DESC, length(name) DESC, name) AS rep FROM (SELECT DISTINCT unnest([p_name, upper(p_name), 'The ' || p_name, p_name || 's', p_name || '!', p_type]) AS name FROM part)")
def surface_groups(spark: SparkSession, d: str) -> DataFrame:
    name = F.col("p_name")
    forms = F.array(name, F.upper(name), F.concat(F.lit("The "), name), F.concat(name, F.lit("s")), F.concat(name, F.lit("!")), F.col("p_type"))
    return L.surface_groups(table(spark, d, "part").select(F.explode(forms).alias("name")))


def items(spark: SparkSession, d: str) -> DataFrame:
    """Distinct part names with their types, each with the vector of its place among them; every other one is new."""
    named = table(spark, d, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("name")).distinct()
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("k"), F.col("embedding").alias("vec"))
    return ranked(named, "name", start=0, name="k").join(e, "k").select("name", (F.col("k") % 2 == 0).alias("is_new"), "vec")


_ITEMS = "(SELECT name, k % 2 = 0 AS is_new, CAST(embedding AS DOUBLE[]) AS vec FROM (SELECT name, row_number() OVER (ORDER BY name) - 1 AS k FROM (SELECT DISTINCT p_name || ' ' || p_type AS name FROM part)) JOIN embeddings ON vec_id = k)"


@query(f"WITH i AS MATERIALIZED (SELECT *, {_tokens('name')} AS t FROM {_ITEMS}), s AS (SELECT a.name AS x, b.name AS y, a.is_new OR b.is_new AS fresh, len(list_intersect(a.t, b.t)) / len(list_distinct(list_concat(a.t, b.t))) + 0.35 * list_cosine_similarity(a.vec, b.vec) AS score FROM i a JOIN i b ON a.name <> b.name AND list_has_any(a.t, b.t)), k AS (SELECT *, row_number() OVER (PARTITION BY x ORDER BY score DESC, y DESC) AS rn FROM s WHERE score >= 0.55) SELECT DISTINCT least(x, y) AS a, greatest(x, y) AS b FROM k WHERE rn <= 40 AND fresh")
def blocked_pairs(spark: SparkSession, d: str) -> DataFrame:
    return L.blocked_pairs(items(spark, d)).select("a", "b")


_COS = "list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"
_LINKS = f"SELECT a.vec_id AS src, b.vec_id AS dst FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id WHERE {_COS} >= 0.4"


def links(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of all vectors with a cosine of 0.4 or more, the smaller id first."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("name"), F.col("embedding").alias("vec"))
    pairs = L.similar_pairs(e, 0.4).select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    return pairs.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"))


@query(_LINKS)
def cosine_pairs(spark: SparkSession, d: str) -> DataFrame:
    return links(spark, d)


@query(f"WITH RECURSIVE l AS MATERIALIZED ({_LINKS}), e AS MATERIALIZED (SELECT src, dst FROM l UNION SELECT dst, src FROM l), r AS (SELECT src AS node, src AS seen FROM e UNION SELECT r.node, e.dst FROM r JOIN e ON r.seen = e.src) SELECT node, min(seen) AS component FROM r GROUP BY node")
def components(spark: SparkSession, d: str) -> DataFrame:
    return connected_components(links(spark, d))


def members(spark: SparkSession, d: str) -> DataFrame:
    """Customers in clusters of their nation and segment."""
    return table(spark, d, "customer").select(F.col("c_name").alias("name"), F.concat_ws("-", F.col("c_mktsegment"), _text("c_nationkey")).alias("cluster"))


_M = "(SELECT c_name AS name, c_mktsegment || '-' || c_nationkey AS cluster FROM customer)"


@query(f"SELECT name, cluster, coalesce(min(CASE WHEN k % 9 = 0 THEN name END) OVER (PARTITION BY cluster), first_value(name) OVER (PARTITION BY cluster ORDER BY length(name), name)) AS canonical FROM (SELECT name, cluster, c_custkey AS k FROM {_M} JOIN customer ON c_name = name)")
def canonical_names(spark: SparkSession, d: str) -> DataFrame:
    return L.canonical_names(members(spark, d), table(spark, d, "customer").where("c_custkey % 9 = 0").select(F.col("c_name").alias("name")))  # known names, a part of the model


def _decisions(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.select(F.col("c_name").alias("a"), F.concat(F.lit("Customer#"), F.lpad((F.col("c_custkey") + 25).cast("string"), 9, "0")).alias("b"), (F.col("c_custkey") % 4 == 0).alias("same"))


_D = "(SELECT c_name AS a, 'Customer#' || lpad(CAST(c_custkey + 25 AS VARCHAR), 9, '0') AS b, c_custkey % 4 = 0 AS same FROM customer)"


@query(f"SELECT a, b, x.cluster FROM {_D} JOIN {_M} x ON x.name = a JOIN {_M} y ON y.name = b WHERE NOT same AND x.cluster = y.cluster")
def conflicts(spark: SparkSession, d: str) -> DataFrame:
    return L.conflicts(members(spark, d), _decisions(spark, d))


@query(f"SELECT 'customers' AS category, 'exact' AS mode, (SELECT count(*) FROM {_M}) AS total, (SELECT count(*) FROM {_D}) AS compared, (SELECT count(*) FROM {_D} WHERE same) AS same, (SELECT count(DISTINCT cluster) FROM {_M}) AS clusters, (SELECT count(*) FROM {_D} JOIN {_M} x ON x.name = a JOIN {_M} y ON y.name = b WHERE NOT same AND x.cluster = y.cluster) AS conflicts")
def linking_stats(spark: SparkSession, d: str) -> DataFrame:
    return L.linking_stats(_decisions(spark, d), members(spark, d), "customers", "exact")


@query(f"SELECT name, CASE WHEN length(cluster) % 2 = 0 THEN name ELSE cluster END AS cluster FROM {_M}")
def disband(spark: SparkSession, d: str) -> DataFrame:
    m = members(spark, d)
    verdicts = m.select("cluster", F.when(F.char_length("cluster") % 2 == 0, F.lit(False)).when(F.char_length("cluster") % 3 == 0, F.lit(True)).alias("same")).distinct()
    return L.disband(m, verdicts)


_RENAMED = "(SELECT DISTINCT p_name AS name, CASE WHEN length(p_name) % 3 = 0 THEN upper(p_name) ELSE p_name END AS canonical FROM part)"
_CANONICAL = f"SELECT name, CASE WHEN length(name) % 5 = 0 THEN 'prior ' || name ELSE canonical END AS canonical FROM {_RENAMED}"


@query(f"SELECT seq, coalesce(s.canonical, subject) AS subject, CASE WHEN predicate = 'made as' THEN 'is of type' ELSE predicate END AS predicate, CASE WHEN {_is_literal('object')} THEN object ELSE coalesce(o.canonical, object) END AS object FROM {_T} LEFT JOIN ({_CANONICAL}) s ON s.name = subject LEFT JOIN ({_CANONICAL}) o ON o.name = object")
def rewrite_triplets(spark: SparkSession, d: str) -> DataFrame:
    name = F.col("name")
    mapped = table(spark, d, "part").select(F.col("p_name").alias("name")).distinct().withColumn("canonical", F.when(F.char_length(name) % 3 == 0, F.upper(name)).otherwise(name))
    prior = mapped.where(F.char_length("name") % 5 == 0).select(name.alias("surface"), F.concat(F.lit("prior "), name).alias("canonical"))
    relations = spark.createDataFrame([("made as", "is of type")], "name string, canonical string")
    return L.rewrite(triplets(spark, d), L.honour_prior(mapped, prior), relations).select("seq", "subject", "predicate", "object")


@query("SELECT DISTINCT name FROM (SELECT c_name AS name FROM customer UNION SELECT n_name FROM nation) WHERE name NOT IN (SELECT c_name FROM customer WHERE c_custkey % 2 = 0)")
def new_names(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    fresh = c.select(F.col("c_name").alias("name")).union(table(spark, d, "nation").select("n_name"))
    return L.new_names(fresh, c.where("c_custkey % 2 = 0").select(F.col("c_name").alias("name")))  # names mapped before


@query("SELECT name, bool_or(is_new) AS is_new FROM (SELECT c_name AS name, true AS is_new FROM customer UNION ALL SELECT n_name, false FROM nation UNION ALL SELECT c_name, false FROM customer WHERE c_custkey % 2 = 0) GROUP BY name")
def universe(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    known = table(spark, d, "nation").select(F.col("n_name").alias("name")).union(c.where("c_custkey % 2 = 0").select("c_name"))
    return L.universe(c.select(F.col("c_name").alias("name")), known)


@query("SELECT c_name AS name, CASE WHEN c_custkey % 15 < 12 THEN 'kind ' || (c_custkey % 15) ELSE 'individual' END AS answer FROM customer")
def batch_zip(spark: SparkSession, d: str) -> DataFrame:
    """Batches of fifteen names, of which a model answered the first twelve."""
    c = table(spark, d, "customer")
    batches = c.groupBy(F.floor(F.col("c_custkey") / 15).alias("batch")).agg(F.array_sort(F.collect_list(F.struct("c_custkey", "c_name"))).alias("x")).select("batch", F.transform("x", lambda s: s["c_name"]).alias("names"))
    answered = batches.withColumn("answers", F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: F.concat(F.lit("kind "), i.cast("string"))))
    return L.zipped(answered, "individual").select("name", "answer")


# ---- mapping and construction ----


def _names(spark: SparkSession, d: str) -> DataFrame:
    """What is known of the triplets' names: part types are classes, their labels in lower case; "opened" is a datatype property."""
    p = table(spark, d, "part").select(F.col("p_type").alias("name")).distinct().select("name", F.lit("class").alias("kind"), F.lower("name").alias("label"), F.concat(F.lit("parts made "), "name").alias("comment"))
    r = spark.createDataFrame([("opened", "datatype_property", "Opened On", "the first day"), ("has size", "object_property", "has size", "")], p.schema)
    return p.union(r)


def _learned(spark: SparkSession) -> DataFrame:
    rows = [(1, "classes", "Economy", TFL + "x"), (2, "classes", " promo ", TFL + "y"), (3, "classes", "standard", TFL + "z"), (4, "predicates", "Made  as", TFL + "madeAs"), (5, "predicates", "located in", TFL + "locatedIn")]
    return G.schema_catalog(spark, spark.createDataFrame(rows, SCHEMA_CATALOG))


_KNOWN = "('economy', 'promo', 'standard')"
_CLASS = "SELECT DISTINCT p_type AS name FROM part"
_ENDS = f"SELECT name, row_number() OVER (ORDER BY name) AS n FROM (SELECT subject AS name FROM {_T} UNION SELECT object FROM {_T} WHERE NOT {_is_literal('object')})"
_NODES = f"(SELECT 'ent_' || n AS id, n, name, CASE WHEN is_class THEN lower(name) ELSE name END AS label, CASE WHEN is_class THEN 'parts made ' || name ELSE '' END AS comment, '{TFL}' || {_slug('name')} AS iri, CASE WHEN is_class THEN '{TFL}' || {_slug('name')} ELSE '{TFL}TransportEntity' END AS class_iri, CASE WHEN is_class THEN lower(name) ELSE 'TransportEntity' END AS class_label, is_class FROM (SELECT e.*, c.name IS NOT NULL AS is_class FROM ({_ENDS}) e LEFT JOIN ({_CLASS}) c USING (name)) WHERE NOT is_class OR lower(name) IN {_KNOWN})"
_EDGES = f"""(SELECT seq, s.id AS subject_id, s.iri AS subject_iri, predicate, CASE predicate WHEN 'opened' THEN 'Opened On' ELSE predicate END AS predicate_label,
  CASE lower(predicate) WHEN 'made as' THEN '{TFL}madeAs' WHEN 'located in' THEN '{TFL}locatedIn' ELSE '{TFL}' || {_slug('predicate')} END AS predicate_iri, CASE predicate WHEN 'opened' THEN 'datatype_property' ELSE 'object_property' END AS predicate_kind,
  provenance_sentence, CASE WHEN NOT lit THEN o.id END AS object_id, CASE WHEN NOT lit THEN o.iri END AS object_iri, CASE WHEN lit THEN object END AS object_literal,
  CASE WHEN lit THEN '{XSD}' || CASE WHEN regexp_full_match(object, '-?\\d+') THEN 'integer' ELSE 'string' END END AS object_datatype, lower(predicate) IN ('made as', 'located in') AS mapped
  FROM (SELECT *, {_is_literal('object')} AS lit FROM {_T}) t JOIN {_NODES} s ON s.name = subject LEFT JOIN {_NODES} o ON o.name = object WHERE lit OR o.id IS NOT NULL)"""


def _nodes(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    """Triplets, what is known of their names, the catalog, and the nodes, written once for the steps that follow."""
    t, names, found = cut(triplets(spark, d), "mapped-triplets"), cut(_names(spark, d), "names"), _learned(spark)
    return t, names, found, cut(G.map_nodes(t, names, found), "mapped-nodes")


def _edges(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of the triplets."""
    t, names, found, nodes = _nodes(spark, d)
    return nodes, G.map_edges(t, nodes, names, found)


@query(f"SELECT id, name, label, comment, iri, class_iri, class_label, is_class FROM {_NODES}")
def closed_schema_nodes(spark: SparkSession, d: str) -> DataFrame:
    return _nodes(spark, d)[3].drop("n")


@query(f"SELECT * FROM {_EDGES}")
def mapped_edges(spark: SparkSession, d: str) -> DataFrame:
    return _edges(spark, d)[1]


@query(f"SELECT DISTINCT predicate FROM {_EDGES} WHERE NOT mapped")
def unmapped_predicates(spark: SparkSession, d: str) -> DataFrame:
    return G.unmapped_predicates(_edges(spark, d)[1])


def _out(s: str, p: str, o: str, source: str, datatype: str | None = None) -> str:
    p = p if p.startswith("predicate") else f"'{p}'"
    return f"SELECT {s} AS s, {p} AS p, {o} AS o, {'false' if datatype is None else 'true'} AS is_literal, {datatype or chr(39) * 2} AS datatype FROM {source}"


_STRING = f"'{XSD}string'"
_FIRST = f"(SELECT class_iri, arg_min(class_label, n) AS class_label, arg_min(comment, n) AS comment, arg_min(is_class, n) AS is_class FROM {_NODES} GROUP BY class_iri)"
_PROPS = f"(SELECT predicate_iri, arg_min(predicate_label, seq) AS predicate_label, arg_min(predicate_kind, seq) AS predicate_kind FROM {_EDGES} GROUP BY predicate_iri)"
_CONSTRUCTED = " UNION ALL ".join([
    f"SELECT 'http://example.org/tfl/extracted' AS s, '{RDF_TYPE}' AS p, '{OWL}Ontology' AS o, false AS is_literal, '' AS datatype", f"SELECT 'http://example.org/tfl/extracted', '{OWL}imports', 'http://example.org/tfl', false, ''",
    _out("class_iri", RDF_TYPE, f"'{OWL}Class'", _FIRST), _out("class_iri", RDFS + "label", "class_label", _FIRST, _STRING), _out("class_iri", RDFS + "comment", "comment", f"{_FIRST} WHERE is_class AND comment <> ''", _STRING),
    _out("iri", RDF_TYPE, f"'{OWL}NamedIndividual'", f"{_NODES} WHERE NOT is_class"), _out("iri", RDF_TYPE, "class_iri", f"{_NODES} WHERE NOT is_class"), _out("iri", RDFS + "label", "label", f"{_NODES} WHERE NOT is_class", _STRING),
    _out("predicate_iri", RDF_TYPE, f"CASE predicate_kind WHEN 'datatype_property' THEN '{OWL}DatatypeProperty' ELSE '{OWL}ObjectProperty' END", _PROPS), _out("predicate_iri", RDFS + "label", "predicate_label", _PROPS, _STRING),
    _out("predicate_iri", RDFS + "comment", "'the first day'", f"{_PROPS} WHERE predicate_label = 'Opened On'", _STRING),
    _out("subject_iri", "predicate_iri", "object_iri", f"{_EDGES} WHERE object_iri IS NOT NULL"), _out("subject_iri", "predicate_iri", "object_literal", f"{_EDGES} WHERE object_literal IS NOT NULL", "object_datatype"),
    _out(f"'{PT}stmt/' || k", PROV + "value", "provenance_sentence", f"(SELECT provenance_sentence, row_number() OVER (ORDER BY seq) AS k FROM {_EDGES})", _STRING),
])


def constructed(spark: SparkSession, d: str) -> DataFrame:
    nodes, edges = _edges(spark, d)
    return G.construct(nodes, cut(edges, "mapped-edges"), catalog=_names(spark, d).withColumn("base_category", F.when(F.col("kind") == "class", "entities").otherwise("relations")))


@query(_CONSTRUCTED)
def ontology_triples(spark: SparkSession, d: str) -> DataFrame:
    return constructed(spark, d)


@query(f"SELECT DISTINCT s, p, o, CASE WHEN is_literal THEN 'literal' ELSE 'iri' END AS o_kind, datatype FROM ({_CONSTRUCTED})")
def graph_set(spark: SparkSession, d: str) -> DataFrame:
    return G.to_graph(constructed(spark, d)).select("s", "p", "o", "o_kind", "datatype")


@query(f"SELECT DISTINCT '<' || s || '> <' || p || '> ' || CASE WHEN is_literal THEN '\"' || o || '\"' || CASE WHEN datatype = {_STRING} THEN '' ELSE '^^<' || datatype || '>' END ELSE '<' || o || '>' END || ' .' AS value FROM ({_CONSTRUCTED})")
def ntriples_text(spark: SparkSession, d: str) -> DataFrame:
    return turtle.to_ntriples(G.to_graph(constructed(spark, d)))


@query(f"WITH s AS (SELECT iri, label, ord, 0 AS age FROM (VALUES (1, '{TFL}small_ring', 'Old'), (2, '{TFL}kept', 'Kept'), (3, '{TFL}kept', 'Kept again')) v(ord, iri, label) UNION ALL SELECT iri, CASE WHEN k % 2 = 0 THEN name || ' ' || k ELSE replace(string_split(iri, '#')[-1], '_', ' ') END, k, 1 FROM (SELECT '{TFL}' || {_slug('p_name')} AS iri, p_name AS name, p_partkey AS k FROM part)) SELECT row_number() OVER (ORDER BY f) AS ord, 'classes' AS role, label, iri FROM (SELECT iri, arg_max(label, age * 1000000000 + ord) AS label, min(age * 1000000000 + ord) AS f FROM s GROUP BY iri)")
def catalog_upsert(spark: SparkSession, d: str) -> DataFrame:
    old = spark.createDataFrame([(1, "classes", "Old", TFL + "small_ring"), (2, "classes", "Kept", TFL + "kept"), (3, "classes", "Kept again", TFL + "kept")], SCHEMA_CATALOG)
    k = F.col("p_partkey")
    seen = table(spark, d, "part").select(k.cast("long").alias("ord"), F.lit("classes").alias("role"), F.when(k % 2 == 0, F.concat_ws(" ", "p_name", k.cast("string"))).otherwise("").alias("label"), F.concat(F.lit(TFL), T.slug(F.col("p_name"))).alias("iri"))
    return G.upsert_catalog(old, seen)


@query(f"SELECT 1 AS ord, 'classes' AS role, 'Old' AS label, '{TFL}small_ring' AS iri UNION ALL SELECT p_partkey, 'classes', p_name, '{TFL}' || {_slug('p_name')} FROM part WHERE {_slug('p_name')} <> 'small_ring'")
def catalog_append(spark: SparkSession, d: str) -> DataFrame:
    old = spark.createDataFrame([(1, "classes", "Old", TFL + "small_ring")], SCHEMA_CATALOG)
    return G.append_catalog(old, table(spark, d, "part").select(F.col("p_partkey").cast("long").alias("ord"), F.lit("classes").alias("role"), F.col("p_name").alias("label"), F.concat(F.lit(TFL), T.slug(F.col("p_name"))).alias("iri")))


# ---- rules, ontology, validation ----


def facts(spark: SparkSession, d: str) -> DataFrame:
    """Orders related to customers and operated by them, some twice, with labels and a few bad IRIs."""
    o = table(spark, d, "orders")
    order, customer = F.concat(F.lit(PT + "order-"), _text("o_orderkey")), F.concat(F.lit(PT + "customer-"), _text("o_custkey"))
    one = lambda s, p, ob, lit=False: o.select(s.alias("s"), F.lit(p).alias("p"), ob.alias("o"), F.lit(lit).alias("is_literal"), F.lit("").alias("datatype"))
    bad = F.when(F.col("o_orderkey") % 10 == 3, F.concat(F.lit("order "), _text("o_orderkey"))).otherwise(order)
    return one(customer, PT + "operates", order).union(one(order, PT + "relatedTo", customer)).union(one(order, PT + "operatedBy", customer)).union(one(bad, RDFS + "label", F.col("o_orderpriority"), True))


_ORDER, _CUSTOMER = f"'{PT}order-' || o_orderkey", f"'{PT}customer-' || o_custkey"
_F = f"(SELECT {_CUSTOMER} AS s, '{PT}operates' AS p, {_ORDER} AS o, false AS is_literal FROM orders UNION ALL SELECT {_ORDER}, '{PT}relatedTo', {_CUSTOMER}, false FROM orders UNION ALL SELECT {_ORDER}, '{PT}operatedBy', {_CUSTOMER}, false FROM orders UNION ALL SELECT CASE WHEN o_orderkey % 10 = 3 THEN 'order ' || o_orderkey ELSE {_ORDER} END, '{RDFS}label', o_orderpriority, true FROM orders)"


@query(f"SELECT s, p, o FROM (SELECT s, '{RDF_TYPE}' AS p, '{CONNECTED}' AS o FROM {_F} WHERE NOT is_literal UNION SELECT o, '{PT}operatedBy', s FROM {_F} WHERE p = '{PT}operates' UNION SELECT o, '{PT}operates', s FROM {_F} WHERE p = '{PT}operatedBy' UNION SELECT o, '{PT}relatedTo', s FROM {_F} WHERE p = '{PT}relatedTo') EXCEPT SELECT s, p, o FROM {_F}")
def reason_rules(spark: SparkSession, d: str) -> DataFrame:
    return G.reason(facts(spark, d)).select("s", "p", "o")


@query(f"SELECT count(*) AS triple_count, bool_or(p <> '{RDF_TYPE}') AS has_relation, count(*) FILTER (NOT starts_with(s, 'http://')) AS iri_errors, CAST(4 AS BIGINT) AS unmapped_predicates, CAST(2 AS BIGINT) AS linking_conflicts FROM {_F}")
def validate_report(spark: SparkSession, d: str) -> DataFrame:
    return G.report(facts(spark, d), unmapped=4, conflicts=2)


_STEPS = "(SELECT DISTINCT a.l_orderkey || '-' || a.l_linenumber AS src, b.l_orderkey || '-' || b.l_linenumber AS dst FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1)"


@query(f"WITH RECURSIVE e AS MATERIALIZED (SELECT * FROM {_STEPS}), r AS (SELECT src, dst FROM e UNION SELECT r.src, e.dst FROM r JOIN e ON r.dst = e.src) SELECT src, dst FROM r")
def chain_transitive(spark: SparkSession, d: str) -> DataFrame:
    i = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    step = lambda n: F.concat_ws("-", _text("l_orderkey"), n.cast("string"))
    nxt = i.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"))
    return transitive_closure(i.join(nxt, ["l_orderkey", "l_linenumber"]).select(step(F.col("l_linenumber")).alias("src"), step(F.col("l_linenumber") + 1).alias("dst")))


_NETWORK = ((TFL + "hasPart", RDFS + "domain", TFL + "Order"), (TFL + "hasPart", RDFS + "range", TFL + "Part"), (TFL + "Order", RDFS + "subClassOf", TFL + "Route"), (TFL + "Route", OWL + "equivalentClass", TFL + "Service"), (TFL + "hasPart", RDFS + "subPropertyOf", TFL + "touches"), (TFL + "hasPart", OWL + "inverseOf", TFL + "partOf"), (TFL + "near", RDF_TYPE, OWL + "SymmetricProperty"), (TFL + "follows", RDF_TYPE, OWL + "TransitiveProperty"))


def owl_graph(spark: SparkSession, d: str) -> DataFrame:
    """Orders with their parts, regions near each other, nations in a line, and axioms about them."""
    i, n, r = (table(spark, d, x) for x in ("lineitem", "nation", "region"))
    iri = lambda kind, c: F.concat(F.lit(TFL + kind), c.cast("string"))
    one = lambda df, s, p, o: df.select(s.alias("s"), F.lit(p).alias("p"), o.alias("o"))
    rows = one(i, iri("o", F.col("l_orderkey")), TFL + "hasPart", iri("p", F.col("l_partkey"))).distinct()
    rows = rows.union(one(r, iri("r", F.col("r_regionkey")), TFL + "near", iri("r", F.col("r_regionkey") + 1))).union(one(n, iri("n", F.col("n_nationkey")), TFL + "follows", iri("n", F.col("n_nationkey") + 1)))
    rows = rows.union(spark.createDataFrame([*_NETWORK], "s string, p string, o string"))
    return rows.select("s", "p", "o", F.lit("iri").alias("o_kind"), F.lit("").alias("datatype"), F.lit("").alias("lang"))


_O, _P = f"'{TFL}o' || l_orderkey", f"'{TFL}p' || l_partkey"
_TYPED = lambda x, kinds: " UNION ".join(f"SELECT {x} AS s, '{RDF_TYPE}' AS p, '{TFL}{k}' AS o FROM lineitem" for k in kinds)


@query(f"WITH RECURSIVE f AS (SELECT n_nationkey AS a, n_nationkey + 1 AS b FROM nation UNION SELECT f.a, n_nationkey + 1 FROM f JOIN nation ON n_nationkey = f.b) SELECT DISTINCT {_O} AS s, '{TFL}hasPart' AS p, {_P} AS o FROM lineitem UNION SELECT {_O}, '{TFL}touches', {_P} FROM lineitem UNION SELECT {_P}, '{TFL}partOf', {_O} FROM lineitem UNION SELECT '{TFL}r' || r_regionkey, '{TFL}near', '{TFL}r' || (r_regionkey + 1) FROM region UNION SELECT '{TFL}r' || (r_regionkey + 1), '{TFL}near', '{TFL}r' || r_regionkey FROM region UNION SELECT '{TFL}n' || a, '{TFL}follows', '{TFL}n' || b FROM f UNION {_TYPED(_O, ('Order', 'Route', 'Service'))} UNION {_TYPED(_P, ('Part',))} UNION SELECT * FROM (VALUES {', '.join(str(x) for x in _NETWORK)}) v(s, p, o) UNION SELECT * FROM (VALUES ('{TFL}Route', '{RDFS}subClassOf', '{TFL}Service'), ('{TFL}Service', '{RDFS}subClassOf', '{TFL}Route'), ('{TFL}Order', '{RDFS}subClassOf', '{TFL}Service')) v(s, p, o)")
def owl_closure(spark: SparkSession, d: str) -> DataFrame:
    return G.owl_closure(owl_graph(spark, d)).select("s", "p", "o")


@query(f"SELECT '{TFL}o' || l_orderkey AS s, '{TFL}hasPart' AS p, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_partkey) > 1")
def owl_functional_violations(spark: SparkSession, d: str) -> DataFrame:
    return G.functional_violations(owl_graph(spark, d), spark.createDataFrame([(TFL + "hasPart",), (TFL + "near",)], "p string"))


@query("SELECT DISTINCT x.user_id AS s, x.event_type AS a, y.event_type AS b FROM events x JOIN events y ON x.user_id = y.user_id WHERE (x.event_type, y.event_type) IN (('click', 'error'), ('error', 'view'))")
def owl_disjoint_violations(spark: SparkSession, d: str) -> DataFrame:
    types = table(spark, d, "events").select(F.col("user_id").alias("s"), F.col("event_type").alias("o")).distinct()
    return G.disjoint_violations(types, spark.createDataFrame([("click", "error"), ("error", "view")], "a string, b string"))


@query(f"SELECT 'entities' AS base_category, 'class' AS kind, p_type AS label, '{TFL}' || {_slug('p_type')} AS iri FROM (SELECT DISTINCT p_type FROM part) UNION SELECT 'entities', 'individual', replace(replace(p_brand, '#', ' '), '-', ' ') || ' ' || p_partkey, '{TFL}' || {_slug('p_brand')} || '_' || p_partkey FROM part UNION SELECT 'relations', 'datatype_property', 'made', '{TFL}made'")
def ontology_entries(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    cls, own = F.concat(F.lit(TFL), T.slug(F.col("p_type"))), F.concat(F.lit(TFL), T.slug(F.col("p_brand")), F.lit("_"), _text("p_partkey"))
    rows = [p.select(cls.alias("s"), F.lit(RDF_TYPE).alias("p"), F.lit(OWL + "Class").alias("o")).distinct(), p.select(cls.alias("s"), F.lit(RDFS + "label").alias("p"), F.col("p_type").alias("o")).distinct(), p.select(own.alias("s"), F.lit(RDF_TYPE).alias("p"), cls.alias("o"))]
    rows += [spark.createDataFrame([(TFL + "made", RDF_TYPE, OWL + "ObjectProperty"), (TFL + "made", RDF_TYPE, OWL + "DatatypeProperty"), ("_:b", RDF_TYPE, OWL + "Class")], "s string, p string, o string")]
    out = rows[0]
    for x in rows[1:]:
        out = out.unionByName(x)
    return G.extract_ontology(out)


# ---- files and structured dumps ----

_STATE = "CASE doc_id % 3 WHEN 0 THEN sha256(text) WHEN 1 THEN 'changed' END"


@query(f"SELECT doc_id, sha256(text) AS sha256 FROM documents WHERE {_STATE} IS DISTINCT FROM sha256(text)")
def hash_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Documents against a state that has a third of them as they are, a third with another digest, a third not at all."""
    docs = table(spark, d, "documents").select(_text("doc_id").alias("path"), F.sha2("text", 256).alias("sha256"))
    k = F.col("path").cast("long") % 3
    state = docs.select("path", F.when(k == 0, F.col("sha256")).when(k == 1, F.lit("changed")).alias("sha256")).where("sha256 IS NOT NULL")
    return files.changed_files(docs, state).select(F.col("path").cast("long").alias("doc_id"), "sha256")


@query("SELECT brand AS base, arg_max(brand || '-v' || size || '.txt', size) AS path FROM (SELECT DISTINCT 'p/' || p_brand AS brand, p_size AS size FROM part) GROUP BY brand")
def latest_versions(spark: SparkSession, d: str) -> DataFrame:
    return files.latest_version(table(spark, d, "part").select(F.concat(F.lit("p/"), "p_brand", F.lit("-v"), _text("p_size"), F.lit(".txt")).alias("path")).distinct())


_EVENT = "'event ' || event_id"


@query(f"SELECT {_EVENT} AS subject, 'event type' AS predicate, event_type AS object FROM events UNION ALL SELECT {_EVENT}, 'user id', CAST(user_id AS VARCHAR) FROM events UNION ALL SELECT {_EVENT}, 'tags', unnest(['a', 'user ' || user_id]) FROM events UNION ALL SELECT 'user ' || user_id, 'is active', 'True' FROM events")
def json_triplets(spark: SparkSession, d: str) -> DataFrame:
    user, event = F.concat(F.lit("user "), _text("user_id")), F.concat(F.lit("event "), _text("event_id"))
    own = F.struct(user.alias("id"), F.lit(True).alias("isActive"))
    e = table(spark, d, "events").select(F.col("event_id").alias("doc_id"), event.alias("name"), F.col("event_type"), F.col("user_id"), F.from_json("props", "k long").alias("props"), user.alias("user"))
    text = F.concat(F.lit('{"$type": "E", "name": "'), "name", F.lit('", "eventType": "'), "event_type", F.lit('", "userId": '), _text("user_id"), F.lit(', "props": '), F.to_json("props"), F.lit(', "tags": ["a", {"id": "'), "user", F.lit('", "isActive": true}, 7]}'))
    return structured.json_triplets(e.select("doc_id", text.alias("text"))).select("subject", "predicate", "object")


_BLOCKS = "SELECT c_name AS subject, 'market segment' AS predicate, c_mktsegment AS object FROM customer UNION ALL SELECT 'inner ' || c_custkey, '0', 'Undefined' FROM customer UNION ALL SELECT 'inner ' || c_custkey, 'zone', CAST(c_nationkey AS VARCHAR) FROM customer"


@query(_BLOCKS)
def tsv_blocks(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    key, zone = _text("c_custkey"), _text("c_nationkey")
    text = F.concat_ws("\n", F.lit("$type\tx"), F.concat(F.lit("marketSegment\t"), "c_mktsegment"), F.concat(F.lit('name\t"'), "c_name", F.lit('"\tmore')), F.lit("empty\t"), F.concat(F.lit("acctBal\t x"), zone), F.lit("[list]\t1"), F.lit("orphan\t1"), F.lit('0\t"Undefined"'), F.concat(F.lit('line\t{ $type: "L" id: "'), key, F.lit('" name: "inner '), key, F.lit('" }')), F.concat(F.lit("zone\t"), zone))
    return structured.tsv_triplets(c.select(key.alias("doc_id"), text.alias("text"))).select("subject", "predicate", "object")


@query("SELECT CAST(event_id AS VARCHAR) AS doc_id, CAST(CASE event_id % 3 WHEN 2 THEN 0 ELSE 1 END AS BIGINT) AS triplets, event_id % 3 = 2 AS low_confidence FROM events")
def structured_dispatch(spark: SparkSession, d: str) -> DataFrame:
    k, kind = F.col("event_id") % 3, F.col("event_type")
    text = F.when(k == 0, F.concat(F.lit(' [{"id": "e", "kind": "'), kind, F.lit('"}]'))).when(k == 1, F.concat(F.lit("name\te\nkind\t"), kind)).otherwise(F.concat(F.lit("{broken "), kind))
    docs = cut(table(spark, d, "events").select(_text("event_id").alias("doc_id"), text.alias("text")), "structured")
    return structured.low_confidence(docs, structured.structured_triplets(docs))


@query("SELECT stage, sum(seconds) AS seconds FROM (SELECT event_type AS stage, CAST(round(value * 100) AS BIGINT) AS seconds FROM events) GROUP BY stage")
def stage_seconds(spark: SparkSession, d: str) -> DataFrame:
    return sinks.timing_totals(table(spark, d, "events").select(F.col("event_type").alias("stage"), F.round(F.col("value") * 100).cast("long").alias("seconds")))
