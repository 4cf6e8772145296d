"""Surface triplets: keeping, merging, usage, catalogs of names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ternion.functions import text as T

#: Entity labels of a recogniser and the types they stand for.
ENTITY_TYPES = {"ORG": "Organization", "GPE": "Place", "LOC": "Place", "FAC": "Facility", "LAW": "Regulation", "PRODUCT": "TransportProduct", "EVENT": "TransportEvent"}
LEAST_ENTITY = 3


def keep_triplets(t: DataFrame, predicate_too: bool = False) -> DataFrame:
    """subject and object (and predicate) not blank, subject of two characters at least."""
    test = (T.strip(F.col("object")) != "") & (F.char_length(T.strip(F.col("subject"))) >= 2)
    return t.where(test & (T.strip(F.col("predicate")) != "") if predicate_too else test)


def keep_entities(found: DataFrame) -> DataFrame:
    """``(doc_id, seq, surface, label)`` with known labels and three characters; the first of each surface in lower case."""
    table = F.create_map(*[F.lit(x) for kv in ENTITY_TYPES.items() for x in kv])
    good = found.withColumn("type", table[F.col("label")]).where(F.col("type").isNotNull() & (F.char_length(T.strip(F.col("surface"))) >= LEAST_ENTITY))
    first = Window.partitionBy("doc_id", F.lower("surface")).orderBy("seq")
    return good.withColumn("rn", F.row_number().over(first)).where("rn = 1").drop("rn")


def merge_triplets(t: DataFrame) -> DataFrame:
    """The first of each (subject, predicate, object) in lower case, per document, in the order of ``rank`` and ``seq``."""
    low = [F.lower(c) for c in ("subject", "predicate", "object")]
    first = Window.partitionBy("doc_id", *low).orderBy("rank", "seq")
    return t.withColumn("rn", F.row_number().over(first)).where("rn = 1").drop("rn")


def names(t: DataFrame, test_subject: bool = True) -> DataFrame:
    """Distinct ``(base_category, name)``: entities that are no literals, and relations."""
    subjects = t.select(F.lit("entities").alias("base_category"), F.col("subject").alias("name"))
    if test_subject:
        subjects = subjects.where(~T.is_literal(F.col("name")))
    objects = t.where(~T.is_literal(F.col("object"))).select(F.lit("entities").alias("base_category"), F.col("object").alias("name"))
    relations = t.select(F.lit("relations").alias("base_category"), F.col("predicate").alias("name"))
    return subjects.union(objects).union(relations).distinct()


def usage_examples(t: DataFrame, k: int = 3) -> DataFrame:
    """A5: ``(name, n, example)``, the first ``k`` uses of each entity; a triplet counts for its subject, then its object."""
    line = T.usage(F.col("subject"), F.col("predicate"), F.col("object"))
    uses = t.select(F.explode(F.array(F.struct(F.col("subject").alias("name"), F.lit(0).alias("role")), F.struct(F.col("object").alias("name"), F.lit(1).alias("role")))).alias("u"), "seq", line.alias("example"))
    first = Window.partitionBy("name").orderBy("seq", "role")
    return uses.select("u.name", "u.role", "seq", "example").withColumn("n", F.row_number().over(first).cast("long")).where(F.col("n") <= k).select("name", "n", "example")


def has_literal(t: DataFrame) -> DataFrame:
    """Per predicate whether any object is a literal."""
    return t.groupBy("predicate").agg(F.bool_or(T.is_literal(F.col("object"))).alias("has_literal"))


def kind_counts(catalog: DataFrame) -> DataFrame:
    """A10: how many entries of each kind and characteristic."""
    kinds = {"classes": "class", "individuals": "individual", "object_properties": "object_property", "datatype_properties": "datatype_property"}
    return catalog.agg(*[F.count_if(F.col("kind") == v).alias(k) for k, v in kinds.items()], *[F.count_if(F.coalesce(c, F.lit(False))).alias(c) for c in ("symmetric", "transitive", "functional")])


def classify(catalog: DataFrame, literal: DataFrame) -> DataFrame:
    """Unknown entity kinds become individuals; predicates with literal objects become datatype properties without characteristics."""
    c = catalog.join(literal.select(F.col("predicate").alias("name"), "has_literal"), "name", "left")
    data = (F.col("base_category") == "relations") & F.coalesce("has_literal", F.lit(False))
    entity = F.when(F.col("kind").isin("class", "individual"), F.col("kind")).otherwise("individual")
    relation = F.when(data, "datatype_property").when(F.col("kind").isin("object_property", "datatype_property"), F.col("kind")).otherwise("object_property")
    out = c.withColumn("kind", F.when(F.col("base_category") == "relations", relation).otherwise(entity))
    for flag in ("symmetric", "transitive", "functional"):
        out = out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)) & ~data)
    return out.drop("has_literal")


def categories(catalog: DataFrame) -> DataFrame:
    """The catalog with the ``category`` that names are linked in; unknown kinds count as individuals and object properties."""
    relation = F.when(F.col("kind") == "datatype_property", "relations_data").otherwise("relations_object")
    entity = F.when(F.col("kind") == "class", "entities_class").otherwise("entities_individual")
    by_base = F.when(F.col("base_category") == "relations", relation).otherwise(entity)
    return catalog.withColumn("category", by_base)
