"""Event operators on streams: counts by window and sessions, with late data bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_counts(events: DataFrame, time: str, key: str, size: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Counts and sums by key and tumbling window; the same on a stream and on a table."""
    g = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(F.window(time, size).alias("w"), key)
    return g.agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), key, "n")


def sessions(events: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    g = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), key)
    return g.agg(F.count("*").alias("n")).select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), key, "n")
