"""Bars: resampling with completeness, sealing, alignment, parity and content hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hourly(ticks: DataFrame) -> DataFrame:
    """sym, ts, id, price -> hour bars; ties in time by id."""
    first, last = F.min(F.struct("ts", "id", "price")), F.max(F.struct("ts", "id", "price"))
    g = ticks.groupBy("sym", F.date_trunc("hour", "ts").alias("ts")).agg(first.alias("f"), F.max("price").alias("h"), F.min("price").alias("l"), last.alias("x"), F.count("*").alias("v"))
    return g.select("sym", "ts", F.col("f.price").alias("o"), "h", "l", F.col("x.price").alias("c"), "v")


def daily_from_hourly(hours: DataFrame, fetched_through: str | None = None, per_day: int = 24) -> DataFrame:
    """UTC days that have exactly ``per_day`` rows in as many distinct hours and closed by ``fetched_through``."""
    g = hours.groupBy("sym", F.to_date("ts").alias("d")).agg(
        F.min(F.struct("ts", "o")).alias("f"), F.max("h").alias("h"), F.min("l").alias("l"), F.max(F.struct("ts", "c")).alias("x"), F.sum("v").alias("v"), F.count("*").alias("n"), F.countDistinct(F.hour("ts")).alias("hours")
    )
    whole = (F.col("n") == per_day) & (F.col("hours") == per_day)
    sealed = F.lit(True) if fetched_through is None else F.date_add("d", 1).cast("timestamp") <= F.lit(fetched_through).cast("timestamp")
    return g.where(whole & sealed).select("sym", "d", F.col("f.o").alias("o"), "h", "l", F.col("x.c").alias("c"), "v", F.col("n").alias("n_source_bars"))


def misaligned(daily: DataFrame) -> DataFrame:
    """Rows whose time is not a UTC midnight; must be none."""
    return daily.where(F.col("ts") != F.date_trunc("day", "ts"))


def eligible(bars: DataFrame, session: str) -> DataFrame:
    """Bars that closed by the session's midnight, inclusive."""
    return bars.where(F.col("bar_close") <= F.lit(session).cast("timestamp"))


def parity(a: DataFrame, b: DataFrame, tolerance: float) -> DataFrame:
    """Two sources' closes by symbol and day: days in both, and those that differ by more than ``tolerance`` of the mid."""
    x = a.select("sym", "d", F.col("c").alias("ca")).join(b.select("sym", "d", F.col("c").alias("cb")), ["sym", "d"])
    off = F.try_divide(F.abs(F.col("ca") - F.col("cb")), (F.col("ca") + F.col("cb")) / 2)
    return x.withColumn("off", off).groupBy("sym").agg(F.count("*").alias("n"), F.count(F.when(F.col("off") > tolerance, 1)).alias("n_off"), F.max("off").alias("worst"))


def content_hash(bars: DataFrame, scale: int = 1_000_000) -> DataFrame:
    """Per symbol the SHA-256 of its rows in day order, whatever file they came from. Values are scaled to integers, as
    engines print doubles differently."""
    values = [F.round(F.col(c) * scale).cast("long").cast("string") for c in "ohlcv"]
    row = F.struct("d", F.concat_ws("|", F.col("d").cast("string"), *values).alias("r"))
    g = bars.groupBy("sym").agg(F.array_sort(F.collect_list(row)).alias("x"), F.count("*").alias("n"))
    return g.select("sym", "n", F.sha2(F.array_join(F.transform("x", lambda e: e["r"]), "\n"), 256).alias("content_sha256"))
