"""Forward returns. Three definitions that differ where calendars differ; they never share code silently."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import windows as w
from tessera.operators.asof import asof_join

HORIZONS = (5, 20, 60)


def excess_asof(bars: DataFrame, market: DataFrame, horizons=HORIZONS, days: int = 5) -> DataFrame:
    """Return over n rows of the symbol less the market's over the same rows; the market is matched as of each row, at
    most ``days`` old."""
    x = asof_join(bars.select("sym", "d", "c"), market.select("d", F.col("c").alias("m")), None, days=days)
    ahead = lambda c, n: F.try_divide(w.lead(c, n), F.col(c)) - 1
    return x.select("sym", "d", *((ahead("c", n) - ahead("m", n)).alias(f"fwd_{n}d_excess") for n in horizons))


def excess_exact(bars: DataFrame, market: DataFrame, n: int = 60) -> DataFrame:
    """Return over n rows of the symbol less the market's over n rows of its own calendar, from the same day."""
    # the market is one short series; its days are a year's few hundred rows
    m = market.select("d", (F.try_divide(F.lead("c", n).over(Window.orderBy("d")), F.col("c")) - 1).alias("market_return"))
    own = bars.select("sym", "d", (F.try_divide(w.lead("c", n), F.col("c")) - 1).alias("own"))
    return own.join(m, "d", "left").select("sym", "d", (F.col("own") - F.col("market_return")).alias(f"fwd_{n}d_excess_raw"))


def calendar_forward(bars: DataFrame, horizons=(1, 5, 20), benchmark: str | None = None) -> DataFrame:
    """Return to the bar exactly n calendar days later: null where that day has no bar. With ``benchmark``, also the
    excess over that symbol, null for itself; and the day after which each is known."""
    out = bars.select("sym", "d", "c")
    for n in horizons:
        later = bars.select(F.col("sym").alias("_s"), F.date_sub("d", n).alias("_d"), F.col("c").alias("_c"))
        out = out.join(later, (F.col("sym") == F.col("_s")) & (F.col("d") == F.col("_d")), "left")
        out = out.withColumn(f"fwd_{n}d", F.try_divide("_c", "c") - 1).drop("_s", "_d", "_c")
        out = out.withColumn(f"available_after_{n}d", F.when(F.col(f"fwd_{n}d").isNotNull(), F.date_add("d", n + 1)))
    if benchmark is not None:
        b = out.where(F.col("sym") == benchmark).select(F.col("d").alias("_d"), *(F.col(f"fwd_{n}d").alias(f"_b{n}") for n in horizons))
        out = out.join(b, F.col("d") == F.col("_d"), "left")
        for n in horizons:
            out = out.withColumn(f"fwd_{n}d_excess", F.when(F.col("sym") != benchmark, F.col(f"fwd_{n}d") - F.col(f"_b{n}")))
        out = out.drop("_d", *(f"_b{n}" for n in horizons))
    return out.drop("c")
