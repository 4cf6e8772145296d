"""Incremental ingestion of structured files: a file stream whose batches become triplets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ternion.sources.files import BINARY, as_documents, glob_of
from ternion.sources.structured import structured_triplets


def ingest(spark: SparkSession, folder: str, out: str, checkpoint: str, patterns: str = "*.txt,*.json") -> StreamingQuery:
    """Triplets of all files that are new in ``folder``, then stop; called again, it takes what came since.

    The checkpoint keeps each path to one batch. A batch writes folders of its own number (``triplets/batch=N``,
    ``files/batch=N``) and overwrites them when it is run again, so a lost driver or executor leaves nothing twice.
    """
    binary = spark.readStream.format("binaryFile").schema(BINARY).option("pathGlobFilter", glob_of(patterns)).load(folder)

    def write(batch: DataFrame, number: int) -> None:
        docs = as_documents(batch)
        structured_triplets(docs.select(F.col("path").alias("doc_id"), "text")).write.mode("overwrite").parquet(f"{out}/triplets/batch={number}")
        docs.select("path", "sha256").write.mode("overwrite").parquet(f"{out}/files/batch={number}")

    return binary.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
