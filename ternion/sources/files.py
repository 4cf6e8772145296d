"""Files as documents, and the state that tells which of them have changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ternion.functions.parsing import decode_ignoring

#: Files as Spark's binary reader gives them, and the state table.
BINARY = "path string, modificationTime timestamp, length long, content binary"
STATE = "path string, sha256 string"


def glob_of(patterns: str) -> str:
    """Comma-separated patterns as one brace glob; repeated and empty ones count once and not at all."""
    parts = sorted({p.strip() for p in patterns.split(",") if p.strip()})
    if not parts:
        raise ValueError("no file pattern given")
    return parts[0] if len(parts) == 1 else "{" + ",".join(parts) + "}"


def as_documents(binary: DataFrame) -> DataFrame:
    """``(path, sha256, text)``: bytes that are no UTF-8 are left out of the text, not of the digest."""
    return binary.select("path", F.sha2("content", 256).alias("sha256"), decode_ignoring("content").alias("text"))


def scan_files(spark: SparkSession, folder: str, patterns: str = "*.txt,*.json") -> DataFrame:
    """Each file of ``folder`` that matches a pattern, once. No match is an error, raised before any text is read.

    Spark's reader leaves empty files out, so they are no documents and have no state.
    """
    binary = spark.read.format("binaryFile").option("pathGlobFilter", glob_of(patterns)).load(folder)
    if binary.select("path").isEmpty():
        raise FileNotFoundError(f"no files match {patterns} in {folder}")
    return as_documents(binary)


def changed_files(files: DataFrame, state: DataFrame) -> DataFrame:
    """S3: files that the state doesn't hold with the same content."""
    return files.join(state.select("path", "sha256").distinct(), ["path", "sha256"], "left_anti")


def merged_state(state: DataFrame, files: DataFrame) -> DataFrame:
    """The state after ``files``: their digests replace earlier ones of the same path."""
    new = files.select("path", "sha256").dropDuplicates(["path"])
    return state.select("path", "sha256").join(new, "path", "left_anti").unionByName(new)


def latest_version(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """``(base, path)``, for each name the path with the largest number after ``-v``; paths without one are left out."""
    version = F.regexp_extract(path_col, r"-v(\d+)", 1)
    named = paths.where(version != "").select(F.regexp_replace(path_col, r"-v\d+.*$", "").alias("base"), F.col(path_col).alias("path"), version.cast("long").alias("n"))
    return named.groupBy("base").agg(F.max_by("path", F.struct("n", "path")).alias("path"))
