"""Watchlist screening, option surfaces and coverage reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import windows as w


def performance(bars: DataFrame, least: int = 20) -> DataFrame:
    """Per symbol: returns, total return, yearly volatility, Sharpe ratio and largest drawdown."""
    x = bars.select("sym", "d", "c", (F.try_divide("c", w.lag("c")) - 1).alias("r"), F.max("c").over(w.so_far()).alias("top"))
    g = x.groupBy("sym").agg(F.count("r").alias("n"), F.min(F.struct("d", "c")).alias("f"), F.max(F.struct("d", "c")).alias("l"), F.avg("r").alias("m"), F.stddev_samp("r").alias("sd"), F.min(F.try_divide("c", "top") - 1).alias("max_drawdown"))
    year = F.sqrt(F.lit(252.0))
    return g.where(F.col("n") >= least).select("sym", "n", (F.try_divide("l.c", "f.c") - 1).alias("total_return"), (F.col("sd") * year).alias("volatility"), F.try_divide(F.col("m") * year, F.col("sd")).alias("sharpe"), "max_drawdown")


def thresholds(stats: DataFrame) -> DataFrame:
    """Upper median and deviation of the Sharpe ratios, and the level above which a name is added."""
    g = stats.agg(F.array_sort(F.collect_list("sharpe")).alias("s"), F.stddev_samp("sharpe").alias("sd"))  # a row for each name
    mid = F.element_at("s", (F.floor(F.size("s") / 2) + 1).cast("int"))
    return g.select(mid.alias("median"), "sd", (mid + 0.5 * F.col("sd")).alias("add_above"))


def best(stats: DataFrame, n: int) -> DataFrame:
    return stats.orderBy(F.col("sharpe").desc(), "sym").limit(n)


def nearest_atm(contracts: DataFrame, as_of: Column, spot: Column, days: int, slack: int = 10) -> DataFrame:
    """Per root and kind the implied volatility of the expiry nearest to ``days`` ahead (within slack) and there of the
    strike nearest to the spot."""
    dte = F.abs(F.datediff("expiry", as_of) - days)
    near = contracts.withColumns({"_dte": dte, "_off": F.abs(F.col("strike") - spot)}).where(F.col("_dte") <= slack)
    pick = F.min(F.struct("_dte", "expiry", "_off", "strike", "iv")).alias("x")
    return near.groupBy("root", "kind").agg(pick).select("root", "kind", "x.expiry", "x.strike", "x.iv")


def row_coverage(df: DataFrame, columns: list[str], least: float) -> DataFrame:
    """Rows whose share of known columns is ``least`` or more."""
    known = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    return df.where(known >= least * len(columns))


def source_coverage(universe: DataFrame, **sources: DataFrame) -> DataFrame:
    """Per source the symbols of the universe that it has, its share and its last day."""
    out = None
    for name, df in sources.items():
        have = df.groupBy("sym").agg(F.max("d").alias("last"))
        one = universe.join(have, "sym", "left").agg(F.lit(name).alias("source"), F.count("last").alias("n"), F.avg(F.col("last").isNotNull().cast("double")).alias("share"), F.max("last").alias("last"))
        out = one if out is None else out.unionByName(one)
    return out
