"""Incremental ingest with Structured Streaming; an extension, as the batch operators cover the data model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from foliospark.api import Workspace
from foliospark.schemas import BLOCKS, PAPER_META


def stream_blocks(spark: SparkSession, path: str, *, files_per_trigger: int = 100) -> DataFrame:
    """Blocks of Parquet files as they appear under the path."""
    return spark.readStream.schema(BLOCKS).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def ingest_stream(blocks: DataFrame, workspace: Workspace, checkpoint: str, *, available_now: bool = True) -> StreamingQuery:
    """Ingests each micro-batch; documents already there are skipped, so a batch that is run again changes nothing."""

    def batch(df: DataFrame, _: int) -> None:
        workspace.ingest(df)

    writer = blocks.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_category(spark: SparkSession, path: str, category: str, start: str, end: str) -> DataFrame:
    """Paper metadata (JSON files) of a category, published from start to end, as files appear."""
    day = F.to_date(F.try_to_timestamp("published"))
    rows = spark.readStream.schema(PAPER_META).json(path)
    return rows.where(F.array_contains("categories", category) & day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def event_windows(events: DataFrame, *, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts and sums of events by type and tumbling window; rows later than the watermark are dropped."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select("w.start", "w.end", "event_type", "n", "total")
