"""Split factors: measured as a step function of price ratios, or reconstructed from a calendar of splits."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def reconstructed(calendar: DataFrame, splits: DataFrame) -> DataFrame:
    """(sym, d) with the product of the ratios of all splits that come later: a running product from the end, one
    stream per symbol, no join of days with splits. The ratios are multiplied, as logarithms would lose digits with many splits."""
    days = calendar.select("sym", "d", F.lit(1.0).alias("ratio"), F.lit(1).alias("is_day"))
    both = days.unionByName(splits.select("sym", "d", "ratio", F.lit(0).alias("is_day")))
    later = Window.partitionBy("sym").orderBy(F.col("d").desc(), F.col("is_day").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("factor", F.product("ratio").over(later)).where("is_day = 1").select("sym", "d", "factor")


def _merged(levels: list[list], least: int, dates: set) -> list[list]:
    """Segments [first, last, median log ratio] shorter than ``least`` and not at a known split join their nearest
    neighbour, the shortest first; this is sequential by nature."""
    while len(levels) > 1:
        short = [(s[1] - s[0] + 1, i) for i, s in enumerate(levels) if s[1] - s[0] + 1 < least and not (s[3] in dates)]
        if not short:
            break
        i = min(short)[1]
        near = [j for j in (i - 1, i + 1) if 0 <= j < len(levels)]
        j = min(near, key=lambda k: abs(levels[k][2] - levels[i][2]))
        a, b = sorted((i, j))
        keep = levels[j][2]
        levels[a : b + 1] = [[levels[a][0], levels[b][1], keep, levels[a][3]]]
    return levels


def measured(prices: DataFrame, splits: DataFrame, step: float = 0.002, least: int = 5, worst: float = 0.05) -> DataFrame:
    """sym, d, raw, adjusted -> factor (raw over adjusted as a step function that ends at 1) and ok, per day.

    A step is a change of the log ratio by more than ``step``. Per symbol in pandas: merging segments has no window form.
    """
    both = prices.select("sym", "d", "raw", "adjusted", F.lit(None).cast("double").alias("ratio")).unionByName(splits.select("sym", "d", F.lit(None).cast("double").alias("raw"), F.lit(None).cast("double").alias("adjusted"), "ratio"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        known = {d for d, r in zip(pdf["d"], pdf["ratio"], strict=True) if r == r and r is not None}
        p = pdf[pdf["raw"].notna() & pdf["adjusted"].notna()].sort_values("d").reset_index(drop=True)
        if p.empty:
            return pd.DataFrame({"sym": [], "d": [], "factor": [], "ok": []})
        x = np.log(p["raw"].to_numpy(float) / p["adjusted"].to_numpy(float))
        cut = [0, *(np.flatnonzero(np.abs(np.diff(x)) > step) + 1), len(x)]
        near = {d + pd.Timedelta(days=k) for d in map(pd.Timestamp, known) for k in range(-5, 6)}
        stamp = pd.to_datetime(p["d"])
        levels = _merged([[a, b - 1, float(np.median(x[a:b])), stamp[a]] for a, b in zip(cut[:-1], cut[1:], strict=True)], least, near)
        fitted = np.concatenate([np.full(b - a + 1, m) for a, b, m, _ in levels])
        return pd.DataFrame({"sym": p["sym"], "d": p["d"], "factor": np.exp(fitted - fitted[-1]), "ok": bool(np.abs(x - fitted).max() <= worst)})

    return both.groupBy("sym").applyInPandas(solve, "sym string, d date, factor double, ok boolean")


def outliers(x: str, n: int = 7) -> tuple:
    """(spike, gross): more than 1.5 times both neighbours, or 20 times off the centred median of n rows (three at least)."""
    s = Window.partitionBy("sym").orderBy("d")
    v, before, after = F.col(x), F.lag(x).over(s), F.lead(x).over(s)
    around = s.rowsBetween(-(n // 2), n // 2)
    mid = F.when(F.count(v).over(around) >= 3, F.percentile(v, 0.5).over(around))
    spike = (v > 1.5 * before) & (v > 1.5 * after)
    gross = (v > 20 * mid) | (v < mid / 20)
    return F.coalesce(spike, F.lit(False)), F.coalesce(gross, F.lit(False))
