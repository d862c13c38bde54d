"""Incremental ingest: exact duplicates dropped within a watermark, tallies per window, and resumption."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import dedup_key


def read_records_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 16) -> DataFrame:
    """Lines of JSON that arrive as new files in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def drop_repeated(docs: DataFrame, time: str = "ingested_at", within: str = "7 days") -> DataFrame:
    """The first arrival of every text; state is kept for texts no older than the watermark."""
    return docs.withColumn("dedup_key", dedup_key(F.col("text"))).withWatermark(time, within).dropDuplicatesWithinWatermark(["dedup_key"])


def arrivals(docs: DataFrame, time: str = "ingested_at", window: str = "1 day", late: str = "7 days") -> DataFrame:
    """Documents per source and window; late rows count until the watermark has passed their window."""
    return docs.withWatermark(time, late).groupBy(F.window(time, window).alias("window"), "source_id").agg(F.count("*").alias("documents"))


def pending(samples: DataFrame, done: DataFrame, key: str = "fingerprint") -> DataFrame:
    """The rows whose fingerprint is not done yet."""
    return samples.join(done.select(key).distinct(), key, "left_anti")
