"""Incremental runs: new pages in, chunks out, each once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sievework.operators.ingest import boilerplate_reason, chunk_key, keep_chunks, window_chunks
from sievework.schemas import PAGE


def page_stream(spark: SparkSession, folder: str, files_a_batch: int = 100) -> DataFrame:
    """Pages as JSON lines that land in a folder."""
    return spark.readStream.schema(PAGE).option("maxFilesPerTrigger", files_a_batch).json(folder)


def stream_chunks(pages: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append chunks of new pages to a Parquet table, one folder a batch, so that a batch done again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        chunks = keep_chunks(window_chunks(batch.filter("page_content is not null"), ["source_file", "page"]))
        keyed = chunks.withColumn("reason", boilerplate_reason(F.col("page_content"))).withColumn("key", chunk_key(F.col("source_file"), F.col("page"), F.col("start_index")))
        keyed.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def log_counts(log: DataFrame, late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Calls and keys by run and hour; records later than ``late`` are dropped."""
    return log.withWatermark("appended_at", late).groupBy(F.window("appended_at", window), "fingerprint").agg(F.count("*").alias("calls"), F.approx_count_distinct("chunk_key").alias("keys"))
