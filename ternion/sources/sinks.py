"""Small files of a run: JSON states, reports, timings; and graphs as text. All go through Spark's file systems."""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ternion.sources.turtle import to_ntriples


def _file(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One file with a text, on whatever file system holds the path."""
    system, target = _file(spark, path)
    out = system.create(target, True)
    out.write(bytearray(text.encode("utf-8", "ignore")))
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A file's text; None if there is none."""
    system, target = _file(spark, path)
    if not system.exists(target):
        return None
    rows = spark.read.format("binaryFile").load(path).select("content").collect()  # one small file
    return bytes(rows[0]["content"]).decode("utf-8") if rows else ""


def save_json(spark: SparkSession, path: str, payload: object) -> None:
    """K3, K5: a small payload as indented ASCII JSON; what JSON lacks is written as text."""
    write_text(spark, path, json.dumps(payload, indent=2, ensure_ascii=True, default=str))


def load_json(spark: SparkSession, path: str, default: object) -> object:
    """A JSON file's payload, else the default."""
    text = read_text(spark, path)
    return default if text is None else json.loads(text)


def save_rows(df: DataFrame, path: str) -> None:
    """K10, K3 for tables: rows as Parquet, replacing what stood there."""
    df.write.mode("overwrite").parquet(path)


def load_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """S7 for tables: the rows of a path, none if there is none."""
    system, target = _file(spark, path)
    return spark.read.schema(schema).parquet(path) if system.exists(target) else spark.createDataFrame([], schema)


def write_graph(graph: DataFrame, path: str) -> None:
    """K2, K7: a graph as text files, each of them both N-Triples and Turtle."""
    to_ntriples(graph).write.mode("overwrite").text(path)


class Timings:
    """K4: seconds by stage, added up."""

    def __init__(self) -> None:
        self.seconds: dict[str, float] = {}

    @contextmanager
    def stage(self, name: str) -> Iterator[None]:
        start = time.monotonic()
        try:
            yield
        finally:
            self.seconds[name] = self.seconds.get(name, 0.0) + time.monotonic() - start


def timing_totals(rows: DataFrame) -> DataFrame:
    """``(stage, seconds)`` summed, the slowest first."""
    return rows.groupBy("stage").agg(F.sum("seconds").alias("seconds")).orderBy(F.desc("seconds"), "stage")


def profile(seconds: dict[str, float]) -> str:
    """K4: stages from the slowest on, and their total."""
    rows = sorted(seconds.items(), key=lambda x: (-x[1], x[0]))
    lines = [f"{name:<30} | {s:>14.2f}s" for name, s in [*rows, ("total", sum(seconds.values()))]]
    return "\n".join(lines) + "\n"


def evaluation_report(queries: list[tuple[str, object, float]], seconds: float, megabytes: float) -> str:
    """K6: markdown on queries given as (title, rows or error, seconds)."""
    head = ["# Pipeline Evaluation Report", "", "## Quantitative Metrics", f"- **Total Graph Load & Query Time:** {seconds:.2f} seconds", f"- **Peak Memory Usage:** ~{megabytes:.2f} MB", "", "## Query Quality (Competency Questions)", ""]
    table = ["| Query | Results Found | Execution Time (s) |", "|---|---|---|", *(f"| {t} | {n} | {s:.3f} |" for t, n, s in queries)]
    return "\n".join([*head, *table]) + "\n"


def completion_report(gaps: list[dict[str, str]], prompt: str) -> str:
    """K7: markdown on stations without a zone, given as station, name, answer and zone (null: none read)."""
    said = lambda g: f"predicted Zone {g['zone']}. Triples added to graph." if g["zone"] is not None else f"answered {g['answer']!r}, no zone read."
    parts = ["# Knowledge Graph Completion Analysis", "", f"## Identified Gaps ({len(gaps)})", *(f"- {g['name']}" for g in gaps), "", f"**Prompt Used:** `{prompt}`", "", "## Results and Completion", "", *(f"- **{g['name']}**: {said(g)}" for g in gaps)]
    return "\n".join(parts) + "\n"
