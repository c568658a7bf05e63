"""A timeline kept up to date from a stream of dated records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def daily_counts(records: DataFrame, at: str, kind: str, late: str = "1 day") -> DataFrame:
    """(day, kind, n) over windows of a day; records later than the watermark are dropped by it."""
    counted = records.withWatermark(at, late).groupBy(F.window(at, "1 day"), kind).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("day"), kind, "n")


def first_seen(records: DataFrame, key: str, at: str, late: str = "1 day") -> DataFrame:
    """Each key once within the watermark."""
    return records.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def append_timeline(spark: SparkSession, source: str, schema, target: str, checkpoint: str, prepare) -> StreamingQuery:
    """Files that appear in `source` go through prepare(batch) to the timeline at `target`, a folder a batch: a batch that is
    tried again overwrites its own folder, so that each record counts once."""

    def write(batch: DataFrame, number: int) -> None:
        prepare(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
