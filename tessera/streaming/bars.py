"""Bars from a stream: an additive form of the batch resampling, with late data and repeated rows defined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_stream(ticks: DataFrame, late: str = "2 hours") -> DataFrame:
    """A stream of (sym, ts, id, price) as UTC day bars, emitted once the watermark has passed the day. A tick that comes
    twice counts once; one that is later than ``late`` is dropped."""
    once = ticks.withWatermark("ts", late).dropDuplicatesWithinWatermark(["sym", "id"])
    first, last = F.min(F.struct("ts", "id", "price")), F.max(F.struct("ts", "id", "price"))
    g = once.groupBy("sym", F.window("ts", "1 day")).agg(first.alias("f"), F.max("price").alias("h"), F.min("price").alias("l"), last.alias("x"), F.count("*").alias("v"))
    return g.select("sym", F.col("window.start").cast("date").alias("d"), F.col("f.price").alias("o"), "h", "l", F.col("x.price").alias("c"), "v")
