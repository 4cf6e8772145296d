"""Graph files as a triples DataFrame."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ternion.schema import GRAPH
from ternion.sources.files import glob_of
from ternion.sources.rdfxml import parse_graph

PATTERNS = "*.owl,*.ttl,*.rdf"


def read_graph(spark: SparkSession, path: str | list[str], patterns: str | None = None) -> DataFrame:
    """All triples of the Turtle and RDF/XML files at a path, a glob or several, through Spark's own reader: a set, with term kinds.

    ``patterns`` picks files of a folder. Blank labels of different files never meet. No file is an error.
    """
    reader = spark.read.format("binaryFile")
    files = (reader.option("pathGlobFilter", glob_of(patterns)) if patterns else reader).load(path)
    if files.select("path").isEmpty():
        raise FileNotFoundError(f"no graph files in {path}")

    def parse(batches):
        import pandas as pd

        names = [f.split()[0] for f in GRAPH.split(", ")]
        for pdf in batches:
            rows = [r for p, c in zip(pdf["path"], pdf["content"], strict=True) for r in parse_graph(bytes(c).decode("utf-8"), p)]
            yield pd.DataFrame(rows, columns=names)

    return files.select("path", "content").mapInPandas(parse, GRAPH).distinct()


class GraphSource(DataSource):
    """``spark.read.format("graph").load(path)`` for files that the driver and all executors can open; `read_graph` reads from any store."""

    @classmethod
    def name(cls) -> str:
        return "graph"

    def schema(self) -> str:
        return GRAPH

    def reader(self, schema: object) -> DataSourceReader:
        return _Reader(self.options["path"])


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path.removeprefix("file://")

    def partitions(self) -> list[InputPartition]:
        import glob
        import os

        found = sorted(f for p in PATTERNS.split(",") for f in glob.glob(os.path.join(self.path, p))) if os.path.isdir(self.path) else sorted(glob.glob(self.path))
        if not found:
            raise FileNotFoundError(self.path)
        return [InputPartition(p) for p in found]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with open(partition.value, encoding="utf-8") as f:
            yield from parse_graph(f.read(), partition.value)
