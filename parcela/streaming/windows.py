"""Event-time windows over streams of events; an addition to the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def activity(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Events and their mean value by window and type; what comes later than ``late`` is not counted."""
    counted = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.avg("value").alias("mean"))
    return counted.select(F.col("window.start").alias("start"), "event_type", "n", "mean")
