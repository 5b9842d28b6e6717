"""Frames of macro series: z-scores of levels and changes, series without enough coverage left out with a reason.

Market series change relatively and are judged on the z-scores of the days before the training's end; released rates change
absolutely, become known a number of calendar rows after their release, and are judged on their values up to the frame's end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import windows as w
from tessera.operators import factors
from tessera.operators.asof import asof_join

TRANSFORMS = ["level_z", "chg_5d_z", "chg_20d_z"]


def _scores(df: DataFrame, relative: bool, window: int) -> DataFrame:
    x = df.withColumns({f"_{n}": factors.change("c", n, relative) for n in (5, 20)})
    return x.withColumns({k: factors.rolling_z(F.col(c), window) for k, c in zip(TRANSFORMS, ("c", "_5", "_20"), strict=True)}).drop("_5", "_20")


def market_scores(series: DataFrame, until: Column, window: int = 252) -> DataFrame:
    """(sym, d, scores, c, judged) of (sym, d, c); judged: whether the day counts for coverage, null or not, and is known."""
    x = _scores(series.select("sym", "d", F.col("c").cast("double").alias("c")), True, window)
    inside = (F.col("d") >= F.date_sub(until, 2 * window)) & (F.col("d") <= until)
    return x.withColumn("judged", F.when(inside, F.col("level_z").isNotNull()))


def released(series: DataFrame, calendar: DataFrame, lags: dict[str, int]) -> DataFrame:
    """(sym, d, c) of each series of ``lags`` on every calendar day: the last release, so many calendar rows later."""
    days = calendar.select("d").distinct().select(F.explode(F.array(*map(F.lit, sorted(lags)))).alias("sym"), "d")
    x = asof_join(days, series.select("sym", "d", F.col("c").cast("double").alias("c")))
    later = F.coalesce(*(F.when(F.col("sym").isin(*(s for s, k in lags.items() if k == n)), w.lag("c", n) if n else F.col("c")) for n in sorted(set(lags.values()))))
    return x.select("sym", "d", later.alias("c"))


def rate_scores(series: DataFrame, calendar: DataFrame, lags: dict[str, int], until: Column, window: int = 252) -> DataFrame:
    """As ``market_scores``, of released rates. Days are judged from 2 * window rows before the calendar day nearest to ``until``
    (of two, the later) to the calendar's end."""
    x = _scores(released(series, calendar, lags), False, window)
    at = F.row_number().over(w.series())
    nearest = F.min(F.struct(F.abs(F.datediff("d", until)).alias("a"), (-F.unix_date("d")).alias("b"), F.col("_at").alias("at"))).over(Window.partitionBy("sym"))
    x = x.withColumn("_at", at).withColumn("_near", nearest["at"])
    return x.withColumn("judged", F.when(F.col("_at") >= F.col("_near") - 2 * window, F.col("c").isNotNull())).drop("_at", "_near")


def verdicts(scores: DataFrame, wanted: DataFrame, least: float = 0.95) -> DataFrame:
    """(sym, used, share, reason) of every wanted series: without rows, or known on less than ``least`` of its judged days. A
    series with no judged day is used."""
    per = scores.groupBy("sym").agg(F.count("c").alias("n"), F.avg(F.col("judged").cast("double")).alias("share"))
    x = wanted.select("sym").distinct().join(per, "sym", "left")
    reason = F.when(F.coalesce("n", F.lit(0)) == 0, "no_rows").when(F.col("share") < least, F.lit("coverage"))
    return x.select("sym", reason.isNull().alias("used"), "share", reason.alias("reason"))


def frame(scores: DataFrame, verdict: DataFrame) -> DataFrame:
    """(sym, d, scores) of the series that are used."""
    return scores.join(verdict.where("used").select("sym"), "sym", "left_semi").select("sym", "d", *TRANSFORMS)


def wide(frame_: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """One row a day with columns <sym>_<score> of the given series; one that was left out has nulls."""
    one = [F.max(F.when(F.col("sym") == s, F.col(k))).alias(f"{s.lower()}_{k}") for s in symbols for k in TRANSFORMS]
    return frame_.groupBy("d").agg(*one)


def changes(frame_: DataFrame, relative: bool) -> DataFrame:
    """(sym, d, chg): the change of the level's z-score from the row before, relative for market series, absolute for rates."""
    return frame_.select("sym", "d", factors.change("level_z", 1, relative).alias("chg")).where("chg is not null")
