"""Demand from a stream of events: counted by day as the events come, late ones within the watermark included."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import shared_dir


def daily(events: DataFrame, watermark: str = "1 day") -> DataFrame:
    """property, stay_date, events, value: event types by day. events: ts, event_type, value; a stream or a batch."""
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))  # a watermark takes no time without a zone
    rows = events.withWatermark("ts", watermark) if events.isStreaming else events
    made = rows.groupBy(F.window("ts", "1 day").alias("w"), F.col("event_type").alias("property")).agg(F.count("*").alias("events"), F.sum("value").alias("value"))
    return made.select("property", F.to_date("w.start").alias("stay_date"), "events", F.round("value", 4).alias("value"))


def follow(stream: DataFrame, path: str, watermark: str = "1 day") -> DataFrame:
    """Run the stream of events to its present end and return the table of daily demand under path.

    Each micro-batch writes the days it changed to a folder of its own (update mode), which a repeated batch
    overwrites; a day's row is that of its last batch. State of days beyond the watermark is dropped, rows that
    come later than that aren't counted. A second call with the same path goes on where the first one ended."""

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/days/batch={batch}")

    q = daily(stream, watermark).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start()
    q.awaitTermination()
    kind = "property string, stay_date date, events long, value double, batch long"
    written = stream.sparkSession.read.schema(kind).parquet(f"{path}/days")
    last = lambda c: F.max_by(c, "batch").alias(c)
    return written.groupBy("property", "stay_date").agg(last("events"), last("value"))


def replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream over the whole events table, to its end, in a folder of its own for each call."""
    source = spark.read.parquet(f"{sf_dir}/events.parquet")
    stream = spark.readStream.schema(source.schema).parquet(f"{sf_dir}/events.parqu[e]t")
    return follow(stream, f"{shared_dir(spark)}/daily-demand-{uuid.uuid4().hex}")
