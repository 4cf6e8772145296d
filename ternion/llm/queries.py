"""The registered queries of this subpackage, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ternion.llm import ann, ctw, fingerprints, minhash, mixing, packing, passages, secrets, sharding, toxicity
from ternion.llm.tables import table


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes: one row per document."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages removed: the digest columns of every document."""
    return passages.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 39 of near equal size, equal texts together."""
    out = sharding.minimax_shards(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the target weights take, and how often."""
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs.withColumn("domain", mixing.domain_of_source()))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness."""
    return fingerprints.edited_likeness(table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document with the forest's verdict."""
    return secrets.scan(table(spark, sf_dir, "documents"), secrets.train())


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found for every query vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, ann.query_rows(vectors))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context-tree and unigram log-probabilities of every document."""
    return ctw.score(table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    """The packing query's vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_minhash, op2_suffix_dedup, op3_sharding, op4_mixing, op5_fingerprints, op6_secrets, op7_ann, op8_toxicity, op9_ctw, op10_packing)
}


def _fill(level: int) -> str:
    """One level of the water-filling as two common table expressions."""
    path = mixing.LEVELS[: level + 1]
    parent = mixing.LEVELS[:level]
    cols, up = ", ".join(path), ", ".join(parent)
    by = f"PARTITION BY {up} " if up else ""
    cases = "".join(f" WHEN {path[-1]} = '{k}' THEN {v}" for k, v in mixing.WEIGHTS.get(path[-1], {}).items())
    weight = f"CASE{cases} ELSE {mixing.DEFAULT_WEIGHT} END" if cases else str(mixing.DEFAULT_WEIGHT)
    budget = f"(SELECT s{level - 1}.share FROM s{level - 1} WHERE {' AND '.join(f's{level - 1}.{c} = n.{c}' for c in parent)})" if parent else "(SELECT CAST(sum(tokens) AS HUGEINT) * " + f"{mixing.SHARE_PERCENT} // 100 FROM leaves)"
    return f"""
  n{level} AS (SELECT {cols}, CAST(sum(tokens) * {mixing.MAX_EPOCHS} AS HUGEINT) AS c, CAST({weight} AS HUGEINT) AS w FROM leaves GROUP BY {cols}),
  m{level} AS (SELECT n.*, {budget} AS b,
    coalesce(sum(c) OVER ({by}ORDER BY CAST(c AS DOUBLE) / CAST(w AS DOUBLE), {cols} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cb,
    sum(w) OVER ({by}ORDER BY CAST(c AS DOUBLE) / CAST(w AS DOUBLE), {cols} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wa FROM n{level} n),
  f{level} AS (SELECT *, (b - cb) * w >= c * wa AS full_ FROM m{level}),
  s{level} AS (SELECT {cols}, CASE WHEN full_ THEN c ELSE CAST((b - coalesce(sum(CASE WHEN full_ THEN c END) OVER ({by.strip()}), 0)) * w AS HUGEINT)
    // CAST(sum(CASE WHEN NOT full_ THEN w END) OVER ({by.strip()}) AS HUGEINT) END AS share FROM f{level}),"""


ORACLE: dict[str, str] = {
    "op4_mixing": f"""
WITH named AS (
  SELECT doc_id, 'd' || CAST(coalesce(TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 4, 0) AS VARCHAR) AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS tokens FROM documents),
  leaves AS (SELECT domain, lang, source, sum(tokens) AS tokens FROM named GROUP BY domain, lang, source),{_fill(0)}{_fill(1)}{_fill(2)}
  plan AS (SELECT l.domain, l.lang, l.source,
    CASE WHEN l.tokens > 0 THEN s2.share // CAST(l.tokens AS HUGEINT) ELSE 1 END AS whole,
    CASE WHEN l.tokens > 0 THEN s2.share % CAST(l.tokens AS HUGEINT) ELSE 0 END AS rest
    FROM leaves l JOIN s2 ON l.domain = s2.domain AND l.lang = s2.lang AND l.source = s2.source),
  placed AS (SELECT n.*, whole, rest, md5('{mixing.SEED}-' || CAST(whole AS VARCHAR) || '-' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
    FROM named n JOIN plan p ON n.domain = p.domain AND n.lang = p.lang AND n.source = p.source),
  ranked AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM placed),
  taken AS (SELECT doc_id, domain, lang, source, CAST(tokens AS BIGINT) AS tokens,
    CAST(whole AS BIGINT) + CASE WHEN whole < {mixing.MAX_EPOCHS} AND upto <= rest THEN 1 ELSE 0 END AS epochs FROM ranked)
SELECT doc_id, domain, lang, source, tokens, epochs FROM taken WHERE epochs > 0"""
}
