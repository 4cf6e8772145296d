"""Registered queries read their whole tables."""

import math
import random
import re

from ternion.plans import operator_queries


def test_mentions_of_every_language(spark, tmp_path):
    rows = [(1, "Le Pont Neuf est ici", "fr"), (2, "Der Alte Markt", None), (3, "The Big Ben rang", "en"), (4, None, "de"), (5, "rien", "fr")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.mention) for r in operator_queries.QUERIES["text_mentions"](spark, str(tmp_path)).collect()}
    assert got == {(i, m) for i, t, _ in rows for m in re.findall(r"\b[A-Z][a-zA-Z]+(?:\s+[A-Z][a-zA-Z]+)*\b", t or "")}


def test_components_of_all_labels(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, i % 10, [rng.gauss(0, 1) for _ in range(6)]) for i in range(30)]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    near = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True)) >= 0.4 * math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))
    least = {i: i for i, *_ in rows}
    linked = {i for i, _, a in rows for j, _, b in rows if i != j and near(a, b)}
    for _ in rows:
        for i, _, a in rows:
            for j, _, b in rows:
                if i != j and near(a, b):
                    least[i] = least[j] = min(least[i], least[j])
    got = {r.node: r.component for r in operator_queries.QUERIES["components"](spark, str(tmp_path)).collect()}
    assert got == {i: least[i] for i in linked}
