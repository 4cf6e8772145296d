"""From raw documents to packed sequences: the stages of a training-data pipeline, each one operator of ternion.llm.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read as the next
stage's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ternion.llm import minhash, mixing, packing, secrets, toxicity
from ternion.llm.queries import tokenizer_path
from ternion.llm.tables import shrink_executors, table
from ternion.plans.lineage import cut

#: The mixing stage takes at most one epoch of a leaf: no document is packed twice.
MIX_PERCENT, MIX_EPOCHS = 90, 1


def _wrapped(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, lang, source, _row)``: what the operators read, and the whole row beside it, so that columns of any name pass untouched."""
    return docs.select("doc_id", "text", "lang", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold stay.

    Null and empty texts have no terms and the toxic share of the fitting rows as their score, so they stay while
    that share is below the threshold. Repeated rows and ids are scored each for itself; a null doc_id has no
    label. No labels: all stay. An empty table stays empty.
    """
    scored = toxicity.score(_wrapped(docs), toxicity.fit(docs, table(spark, sf_dir, "labels")), carry=("_row",))
    return scored.where("predicted = 0").select("_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays: the one with the smallest doc_id, the first of equal ones.

    Rows are documents whatever their doc_id: repeated ids with different texts are compared like any others, repeated
    rows are copies of which one stays, a null doc_id comes last. A null text is no copy of anything; texts without
    words, the empty one too, are copies of equal texts only. An empty table stays empty.
    """
    rows = cut(_wrapped(docs).select("doc_id", "text", "_row", F.monotonically_increasing_id().alias("at")), "pipeline-rows")
    classes = minhash.near_duplicates(rows.select(F.col("at").alias("doc_id"), "text")).select(F.col("doc_id").alias("at"), "class_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "at"))
    keep = rows.select("at", "doc_id").join(classes, "at").groupBy("class_id").agg(first.alias("x")).select("x.at")
    return rows.join(keep, "at", "left_semi").select("_row.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; confirmed secrets are replaced and lengths updated.

    Null and empty texts stay as they are; repeated rows and null ids are redacted each for itself. An empty table stays empty.
    """
    shrink_executors(spark)  # the joins of near-duplicates have filled their heaps
    out = secrets.redact(docs, secrets.train())
    kind = docs.schema["n_chars"].dataType
    changed = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(kind))
    return out.select(*[changed.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the target weights take, each at most once.

    Null and empty texts have no tokens and cost nothing; null languages and sources are paths of their own; rows with
    equal doc_id (null too) of one source come or go together. An empty table stays empty.
    """
    named = _wrapped(docs).withColumn("domain", mixing.domain_of_source())
    return mixing.mix(named, share_percent=MIX_PERCENT, max_epochs=MIX_EPOCHS, carry=("_row",)).select("_row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences; null and empty texts are the end id alone, rows of equal or null doc_id are packed each for itself, an empty table gives no rows."""
    shrink_executors(spark)  # its encoders come beside heaps that the stages before have filled
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Fitted models, signatures and packing are beyond SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
