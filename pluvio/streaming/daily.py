"""Daily increments: a file stream of events summed by day, late rows up to a watermark included."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def read_events(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def daily_sums(events: DataFrame, watermark: str = "2 days", time: str = "ts", name: str = "event_type", value: str = "value") -> DataFrame:
    """(name, time, value, n) by day. On a stream, a day is final once the watermark has passed it; the same on a table."""
    rows = events.withWatermark(time, watermark) if events.isStreaming else events
    days = rows.groupBy(F.window(time, "1 day").alias("w"), F.col(name).alias("name")).agg(F.sum(value).alias("value"), F.count("*").alias("n"))
    return days.select("name", F.to_date("w.start").alias("time"), "value", "n")


def write_daily(days: DataFrame, path: str, checkpoint: str):
    """Append final days to a table partitioned by day; restarts go on where the checkpoint left off."""
    return days.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).partitionBy("time").trigger(availableNow=True).start(path)
