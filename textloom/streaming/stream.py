"""The same steps over a stream of JSON lines, and windowed counts of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.plans.pipeline import run


def read_stream(spark: SparkSession, folder: str, schema: str, files_a_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger).json(folder)


def process(stream: DataFrame, steps: list, text_col: str = "text") -> DataFrame:
    """Row-wise steps only; a global one needs ``first_seen`` instead."""
    return run(stream, steps, text_col)[0]


def first_seen(stream: DataFrame, time_col: str, key: str = "text", late: str = "1 hour") -> DataFrame:
    """Drops repeats within the watermark."""
    return stream.withColumn("_key", F.md5(key)).withWatermark(time_col, late).dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def windowed_counts(events: DataFrame, time_col: str = "ts", key: str = "event_type", window: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    w = F.window(time_col, window, slide) if slide else F.window(time_col, window)
    return events.withWatermark(time_col, late).groupBy(w, key).agg(F.count("*").alias("n"))
