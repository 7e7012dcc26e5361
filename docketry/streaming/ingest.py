"""Structured Streaming over landed snapshots and run logs: the batch functions, as files arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.classify import blobs, classify, gate
from ..sources.tables import SNAPSHOT


def landed(spark: SparkSession, path: str, schema: str = SNAPSHOT) -> DataFrame:
    """Snapshots as they land, one JSON object a file."""
    return spark.readStream.schema(schema).option("multiLine", True).json(path).withColumn("json_path", F.col("_metadata.file_path"))


def classified(snapshots: DataFrame) -> DataFrame:
    """Class and gate of each snapshot; a stateless chain, so the batch code runs as it is."""
    flat = snapshots.select("processo", "requested_type", "json_path", F.col("snapshot.title").alias("title"), F.col("snapshot.text").alias("text"), F.col("collection.chosen_documento").alias("chosen"))
    return gate(classify(blobs(flat))).select("processo", "requested_type", "json_path", "doc_class", "classification_reason", "validation_status", "publication_status", "discard_reason")


def start(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True) -> StreamingQuery:
    """Runs a sink function a batch; a batch number makes it idempotent."""
    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if once else writer.start()


def level_counts(lines: DataFrame, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Log lines by level and time window; lines later than the watermark are left out."""
    return lines.withWatermark("ts", late).groupBy(F.window("ts", window), F.lower("level").alias("level")).agg(F.count("*").alias("n")).select(F.col("window.start").alias("from"), "level", "n")
