"""Structured dumps as triplets: nested JSON records and tab-separated key/value blocks."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ternion.functions import text as T

#: Keys that name a record, in order, and keys that are no properties.
NAME_KEYS = ("name", "modeName", "id", "naptanId", "stationName")
SKIP_KEYS = {"$type", *NAME_KEYS}
LINE_NAME_KEYS = ("mode name", "name", "id", "naptan id", "station name")
_OUT = "doc_id string, seq long, subject string, predicate string, object string, provenance_sentence string"


#: The keys that name a record met as a value of another, by the shape it comes in.
LINK_KEYS = {"list": NAME_KEYS[:4], "record": NAME_KEYS[:3]}


def _named(record: dict, keys: tuple[str, ...]) -> str:
    """The first value of the keys that is not empty, as text."""
    return next((str(record[k]) for k in keys if record.get(k)), "")


def _properties(record: dict) -> Iterator[tuple[str, object, str]]:
    """(label, value, shape) of a record's properties, lists spelled out; shape says where a value was found."""
    for key, value in record.items():
        if key not in SKIP_KEYS:
            label = re.sub("([A-Z])", r" \1", key).strip().lower()
            if isinstance(value, list):
                yield from ((label, x, "list") for x in value if isinstance(x, (str, dict)))
            else:
                yield label, value, "record"


def json_triplets_of(data: object) -> Iterator[tuple[str, str, str]]:
    """Triplets of named records, depth first; a record without a name is left out with all below it.

    A text, number or truth value is an object as it is; a record gives a link to its name, if it has one among the
    keys of `LINK_KEYS`, and then its own triplets. Numbers within lists and nulls give nothing.
    """
    todo: list[Iterator[dict]] = [iter(data if isinstance(data, list) else [data])]
    open_: list[tuple[str, Iterator[tuple[str, object, str]]]] = []
    while todo or open_:
        if open_ and len(open_) == len(todo):  # a record is being read
            subject, properties = open_[-1]
            found = next(properties, None)
            if found is None:
                open_.pop()
                continue
            label, value, shape = found
            if isinstance(value, dict):
                if name := _named(value, LINK_KEYS[shape]):
                    yield subject, label, name
                todo.append(iter([value]))
            elif isinstance(value, (str, int, float)):
                yield subject, label, str(value)
            continue
        record = next(todo[-1], None)
        if record is None:
            todo.pop()
        elif isinstance(record, dict) and (subject := _named(record, NAME_KEYS).strip()):
            open_.append((subject, _properties(record)))


def json_triplets(docs: DataFrame) -> DataFrame:
    """S8 over ``(doc_id, text)``; texts that are no JSON give no rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                try:
                    found = json_triplets_of(json.loads(text or ""))
                    rows += [(str(doc_id), n, s, p, o, f"{s} {p} {o}") for n, (s, p, o) in enumerate(found)]
                except ValueError:
                    continue
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _OUT.split(", ")])

    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(run, _OUT)


def tsv_triplets(docs: DataFrame) -> DataFrame:
    """S9 over ``(doc_id, text)``: blocks between separator lines, each with the first naming key's value as subject.

    A separator is a line of one field or with a key that starts with ``[``; a numeric key with a further field starts
    a block and is a property of it. The value is the second field without quotes. A value that is an inline object with
    an ``id:`` names its block by the object's name or id. Blank lines and empty values are skipped.
    """
    lines = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.posexplode(F.split("text", r"\R")).alias("n", "raw"))
    lines = lines.select("doc_id", "n", F.split(T.strip(F.col("raw")), "\t").alias("f")).where("f[0] <> '' OR size(f) > 1")
    key = T.strip(F.get("f", F.lit(0)))
    value = F.regexp_replace(T.strip(F.get("f", F.lit(1))), '^"+|"+$', "")
    rows = lines.select("doc_id", "n", key.alias("key"), value.alias("value"), ((F.size("f") == 1) | key.startswith("[")).cast("int").alias("cut"))
    inline = F.col("value").startswith("{") & F.col("value").contains("id:")
    own = F.coalesce(*[F.nullif(F.regexp_extract("value", k + r':\s*"([^"]+)"', 1), F.lit("")) for k in ("name", "id")])
    by = Window.partitionBy("doc_id").orderBy("n")
    numbered = rows.withColumn("opens", F.when(F.col("key").rlike(r"^\d+$"), 1).otherwise(F.col("cut"))).withColumn("block", F.sum("opens").over(by))
    blocks = numbered.where("cut = 0 AND value <> '' AND key <> '$type'").select("doc_id", "n", "block", F.when(inline, F.lit("name")).otherwise(T.camel_label(F.col("key"))).alias("label"), F.when(inline, own).otherwise(F.col("value")).alias("value")).where("value IS NOT NULL")
    names = blocks.where(F.col("label").isin(*LINE_NAME_KEYS)).groupBy("doc_id", "block").agg(F.min_by("value", "n").alias("subject"))
    out = blocks.join(names, ["doc_id", "block"]).where(~F.col("label").isin("$type", *LINE_NAME_KEYS))
    return out.select("doc_id", F.col("n").cast("long").alias("seq"), "subject", F.col("label").alias("predicate"), F.col("value").alias("object"), F.concat_ws(" ", "subject", "label", "value").alias("provenance_sentence"))


def structured_triplets(docs: DataFrame) -> DataFrame:
    """JSON where a text starts like it and parses, blocks elsewhere."""
    marked = docs.withColumn("_json", F.coalesce(T.strip(F.col("text")).rlike(r"^[\{\[]") & F.try_parse_json("text").isNotNull(), F.lit(False)))
    return json_triplets(marked.where("_json")).unionByName(tsv_triplets(marked.where("NOT _json")))


def low_confidence(docs: DataFrame, triplets: DataFrame) -> DataFrame:
    """``(doc_id, triplets, low_confidence)`` of every document: low where it gave none."""
    n = triplets.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    named = docs.select(F.col("doc_id").cast("string").alias("doc_id")).distinct().join(n, "doc_id", "left")
    return named.select("doc_id", F.coalesce("n", F.lit(0)).alias("triplets"), F.col("n").isNull().alias("low_confidence"))
