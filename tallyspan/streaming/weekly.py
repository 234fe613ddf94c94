"""Weekly counts over an unbounded event stream, with late rows up to a watermark.

The batch engine's ISO weeks as Monday-aligned tumbling windows. Each
micro-batch appends the windows it changed; the newest version of a window is
its current count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def weekly_counts(events: DataFrame, ts: str, by: list[str], value: str, late: str = "14 days") -> DataFrame:
    """``(week_start, by, n, total)`` on a stream or a table; rows later than ``late`` behind the newest are dropped on a stream."""
    week = F.window(ts, "7 days", "7 days", "4 days")  # the epoch was a Thursday
    marked = events.withWatermark(ts, late) if events.isStreaming else events
    g = marked.groupBy(week.alias("w"), *by).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return g.select(F.col("w.start").alias("week_start"), *by, "n", "total")


def run_available(counts: DataFrame, path: str, checkpoint: str) -> None:
    """Process all that is there now; each micro-batch is one folder, so a repeated batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def newest_versions(spark: SparkSession, path: str, by: list[str]) -> DataFrame:
    """The last written version of each window."""
    w = Window.partitionBy("week_start", *by).orderBy(F.desc("batch"))
    rows = spark.read.option("basePath", path).parquet(f"{path}/batch=*")
    return rows.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn", "batch")


def user_sessions(events: DataFrame, ts: str, key: str, gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    """``(key, started, n)``: sessions that end after ``gap`` without a row, on a stream or a table."""
    marked = events.withWatermark(ts, late) if events.isStreaming else events
    g = marked.groupBy(F.session_window(ts, gap).alias("s"), key).agg(F.count(F.lit(1)).alias("n"))
    return g.select(key, F.col("s.start").alias("started"), "n")
