"""Document fingerprints by threshold-scaled sketches, with DataFrame functions only.

A sketch holds every distinct word-shingle hash below a fixed fraction of the hash range. The threshold
does not depend on the document, so a sketch grows with its text, the sketch of a union is the union of the
sketches, and the share of one sketch found in another estimates containment however unequal the texts.

A fingerprint is one string: the 64-bit hash of the text, a colon, and the retained hashes in ascending
order, 16 hex digits each. The likeness of two fingerprints is 1 if their heads agree, else the Jaccard
similarity of their sketches, 0 if both are empty.

Nulls and edge cases: a null text is the empty text; texts of one to four words have one shingle, texts
without words none; a null doc_id stands after all others in the descending order; rows with equal doc_id
and text are one document there and each gets its result; equal doc_ids with different texts are ordered by
their texts' hashes; the only document of a table is its own next document; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ternion.plans.lineage import cut

#: One in SCALE shingle hashes is retained.
SCALE, WORDS = 8, 5


def sketch(text: Column, scale: int = SCALE, words: int = WORDS) -> Column:
    """The retained shingle hashes of a text, distinct and ascending."""
    limit = F.lit(min(2**63 - 1, -(2**63) + 2**64 // scale))
    parts = F.transform(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""), lambda w: F.xxhash64(w))

    def joined(h: Column) -> Column:
        last = F.greatest(F.size(h) - words, F.lit(0))
        runs = F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(*[F.get(h, i + (k - 1)) for k in range(words)]))
        return F.when(F.size(h) > 0, F.array_sort(F.array_distinct(F.filter(runs, lambda x: x < limit)))).otherwise(F.array().cast("array<bigint>"))

    # The one-element array binds the word hashes to a variable: they are computed once.
    return F.get(F.transform(F.array(parts), joined), F.lit(0))


def head(text: Column) -> Column:
    """The hash of a whole text."""
    return F.xxhash64(text)


def _hex(x: Column) -> Column:
    return F.lpad(F.hex(x), 16, "0")


def render(text_hash: Column, hashes: Column) -> Column:
    """The fingerprint as a string."""
    return F.lower(F.concat(_hex(text_hash), F.lit(":"), F.array_join(F.transform(hashes, _hex), "")))


def likeness(h1: Column, s1: Column, h2: Column, s2: Column) -> Column:
    """Likeness of two fingerprints given as heads and sketches."""
    union = F.size(F.array_union(s1, s2))
    same = (F.size(s1) + F.size(s2) - union).cast("double")
    return F.when(h1 == h2, F.lit(1.0)).when(union > 0, same / union).otherwise(F.lit(0.0))


def containment(s1: Column, s2: Column) -> Column:
    """The estimated share of the first text's shingles that the second has; null for an empty sketch."""
    return F.when(F.size(s1) > 0, F.size(F.array_intersect(s1, s2)) / F.size(s1))


def merge(s1: Column, s2: Column) -> Column:
    """The sketch of two texts' shingles together."""
    return F.array_sort(F.array_union(s1, s2))


def _followers(keys: DataFrame) -> DataFrame:
    """``(doc_id, h, n_chars, next_id, next_h)`` in the circular order of descending doc_id, without one big sort task."""
    spark = keys.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("doc_id").desc_nulls_last(), F.col("h")]
    dealt = keys.distinct().repartitionByRange(n, *order).sortWithinPartitions(*order)
    dealt = cut(dealt.withColumn("at", F.monotonically_increasing_id()), "fp-order").withColumn("pid", F.shiftright("at", 33))
    runs = dealt.groupBy("pid").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    base = runs.select("pid", "first", (F.sum("n").over(Window.orderBy("pid")) - F.col("n")).alias("base"), F.sum("n").over(Window.partitionBy()).alias("all"))
    ranked = dealt.join(base, "pid").select("doc_id", "h", "n_chars", (F.col("at") - F.col("first") + F.col("base")).alias("rank"), "all")
    nexts = ranked.select(F.col("rank").alias("nr"), F.col("doc_id").alias("next_id"), F.col("h").alias("next_h"))
    return cut(ranked.withColumn("nr", F.expr("(rank + 1) % all")).join(nexts, "nr").drop("rank", "all", "nr"), "fp-next")


def fingerprints(docs: DataFrame, scale: int = SCALE, words: int = WORDS) -> DataFrame:
    """``(doc_id, n_chars, fingerprint, sketch)`` of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", F.char_length(text).cast("long").alias("n_chars"), head(text).alias("h"), sketch(text, scale, words).alias("sketch")).select(
        "doc_id", "n_chars", render(F.col("h"), F.col("sketch")).alias("fingerprint"), "sketch"
    )


def edited_likeness(docs: DataFrame, scale: int = SCALE, words: int = WORDS) -> DataFrame:
    """Fingerprints of every text and of the text with its last third replaced by the next document's start."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    full = rows.select("doc_id", head(F.col("text")).alias("h"), "text", sketch(F.col("text"), scale, words).alias("s"))
    keys = rows.select("doc_id", head(F.col("text")).alias("h"), F.char_length("text").cast("long").alias("n_chars"))
    follow = _followers(keys)
    asked = follow.select(F.col("next_id").alias("doc_id"), F.col("next_h").alias("h"), F.col("doc_id").alias("for_id"), F.col("h").alias("for_h"), F.floor(F.col("n_chars") / 3).cast("int").alias("need"))
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["h"] == b["h"])
    given = (
        full.alias("f")
        .join(asked.alias("q"), same(_at("f"), _at("q")))
        .select("q.for_id", "q.for_h", F.expr("substring(f.text, 1, q.need)").alias("tail"), F.col("f.h").alias("next_h"), F.col("f.s").alias("next_s"))
        .dropDuplicates(["for_id", "for_h"])
    )
    both = full.alias("f").join(given.alias("g"), F.col("f.doc_id").eqNullSafe(F.col("g.for_id")) & (F.col("f.h") == F.col("g.for_h")))
    n = F.char_length("text")
    out = both.select("doc_id", n.cast("long").alias("n_chars"), "h", "s", F.expr("concat(substring(text, 1, char_length(text) - char_length(text) div 3), tail)").alias("edited"), "next_h", "next_s")
    out = out.select("doc_id", "n_chars", "h", "s", F.sha2("edited", 256).alias("edited_sha256"), head(F.col("edited")).alias("eh"), sketch(F.col("edited"), scale, words).alias("es"), "next_h", "next_s")
    return out.select(
        "doc_id", "n_chars", "edited_sha256", render(F.col("h"), F.col("s")).alias("fingerprint"), render(F.col("eh"), F.col("es")).alias("edited_fingerprint"),
        likeness(F.col("h"), F.col("s"), F.col("eh"), F.col("es")).alias("near_edited"), likeness(F.col("h"), F.col("s"), F.col("next_h"), F.col("next_s")).alias("near_next"),
    )


def _at(alias: str) -> dict[str, Column]:
    return {c: F.col(f"{alias}.{c}") for c in ("doc_id", "h")}
