"""Event-driven features on a daily calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.asof import asof_join
from tessera.operators.normalize import median_fill, percent_rank_average


def surprise_history(earn: DataFrame) -> DataFrame:
    """sym, d, surprise -> sue (over the deviation of the four before, two at least, clipped to +-5), momentum (change
    from the one before) and streak (signed run length), per event."""
    s = Window.partitionBy("sym").orderBy("d")
    before = s.rowsBetween(-4, -1)
    sd = F.when(F.count("surprise").over(before) >= 2, F.stddev_samp("surprise").over(before))
    sue = F.col("surprise") / (sd + 1e-6)
    x = earn.withColumn("sue", F.when(sue.isNotNull(), F.least(F.greatest(sue, F.lit(-5.0)), F.lit(5.0))))
    x = x.withColumn("momentum", F.col("surprise") - F.lag("surprise").over(s))
    sign = F.signum("surprise")
    x = x.withColumns({"sign": sign, "_new": F.when(sign != F.coalesce(F.lag(sign).over(s), F.lit(9.0)), 1).otherwise(0)})
    x = x.withColumn("_run", F.sum("_new").over(s.rowsBetween(Window.unboundedPreceding, 0)))
    run = F.row_number().over(Window.partitionBy("sym", "_run").orderBy("d"))
    return x.withColumn("streak", F.col("sign") * run).select("sym", "d", "surprise", "sue", "momentum", "streak")


def drift_after(panel: DataFrame, earn: DataFrame, window: int = 60) -> DataFrame:
    """Post-announcement drift, panel grain: the last event up to the day itself, decaying to 0 over ``window`` days, its
    rank in the day, and missing values by the day's median."""
    x = asof_join(panel, earn.select("sym", "d", "surprise", F.col("d").alias("event_d")))
    age = F.datediff("d", "event_d")
    x = x.withColumn("days_since", F.when(age <= window, age).cast("double"))
    x = x.withColumn("signal", F.when(age <= window, F.col("surprise") * F.greatest(F.lit(0.0), 1 - age / window)))
    x = percent_rank_average(x, "signal", "signal_rank")
    return x.select("sym", "d", *(median_fill(F.col(c)).alias(c) for c in ("days_since", "signal", "signal_rank")))


def drift_next_day(panel: DataFrame, earn: DataFrame) -> DataFrame:
    """The same, loader grain: known from the day after, days clamped to [0, 90], nothing filled."""
    shifted = earn.select("sym", F.date_add("d", 1).alias("d"), "surprise", F.col("d").alias("event_d"))
    x = asof_join(panel, shifted)
    age = F.datediff("d", "event_d")
    return x.select("sym", "d", "surprise", F.when(age.isNotNull(), F.least(F.greatest(age, F.lit(0)), F.lit(90))).cast("long").alias("days_since"))


def trailing_surprise(panel: DataFrame, earn: DataFrame, n: int = 4) -> DataFrame:
    """Sum of the last n surprises, known from the day after."""
    w = Window.partitionBy("sym").orderBy("d").rowsBetween(1 - n, 0)
    sums = earn.select("sym", F.date_add("d", 1).alias("d"), F.sum("surprise").over(w).alias("surprise_sum"))
    return asof_join(panel, sums)


def net_buying(trades: DataFrame, days: int = 90) -> DataFrame:
    """Sum of signed dollars over the last ``days`` calendar days, per day with a trade; all trades of a day count."""
    daily = trades.groupBy("sym", "d").agg(F.sum("dollars").alias("dollars"))
    w = Window.partitionBy("sym").orderBy(F.datediff("d", F.lit("1970-01-01"))).rangeBetween(1 - days, 0)
    return daily.select("sym", "d", F.sum("dollars").over(w).alias("net_buy"))
