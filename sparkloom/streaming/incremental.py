"""Documents that arrive over time: each is chunked once, and a restart goes on where it stopped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.chunking import chunk_documents


def stream_chunks(spark: SparkSession, folder: str, schema: StructType | str, out: str, checkpoint: str, size: int = 3500, overlap: int = 350) -> StreamingQuery:
    """Chunks of all Parquet documents that a folder holds and has not given yet, to Parquet; ends when all are read."""
    docs = spark.readStream.schema(schema).parquet(folder)
    chunks: DataFrame = chunk_documents(docs, size, overlap)
    return chunks.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
