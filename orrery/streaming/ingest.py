"""Incremental ingestion: new document files are cleaned and chunked as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.retrieve import chunked

SCHEMA = "doc_id long, text string"


def chunk_stream(spark: SparkSession, folder: str, size: int = 4096, overlap: int = 500) -> DataFrame:
    """A stream of chunks of the Parquet documents that land in ``folder``."""
    return chunked(spark.readStream.schema(SCHEMA).parquet(folder), size, overlap)


def ingest(chunks: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is there now (exactly once per file) and stop; run again for what comes later."""
    return chunks.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
