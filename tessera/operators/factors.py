"""Momentum, market beta, variance and residual volatility; macro betas and z-scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import windows as w
from tessera.operators.asof import asof_join


def momentum(long: int = 252, skip: int = 21) -> Column:
    return F.try_divide(w.lag("c", skip), w.lag("c", long)) - 1


def _padded(x: str) -> Column:
    return F.last(x, ignorenulls=True).over(w.so_far())


def with_market(bars: DataFrame, market: DataFrame, rows: int = 5) -> DataFrame:
    """Adds r and rm: returns of the symbol and of the market as of its days, the latter at most ``rows`` rows old."""
    x = asof_join(bars, market.select("d", F.col("c").alias("m")), None, rows=rows)
    x = x.withColumns({"_c": _padded("c"), "_m": _padded("m")})
    return x.withColumns({"r": F.try_divide("_c", w.lag("_c")) - 1, "rm": F.try_divide("_m", w.lag("_m")) - 1}).drop("_c", "_m")


def market_beta(n: int = 252) -> Column:
    return w.beta(F.col("r"), F.col("rm"), n)


def variance(n: int = 60) -> Column:
    return w.total(F.col("r") * F.col("r"), n)


def size_z(df: DataFrame, n: int = 60) -> DataFrame:
    """Adds z: rolling z-score of log dollar volume, null to 0."""
    x = df.withColumn("_s", F.ln(F.col("v") * F.col("c") + 1))
    return x.withColumn("z", F.coalesce(F.try_divide(F.col("_s") - w.mean(F.col("_s"), n), w.deviation(F.col("_s"), n)), F.lit(0.0))).drop("_s")


def residual_deviation(n: int = 60, least: int = 10) -> Column:
    """Deviation of the residuals of r on 1, rm and z over n rows: two regressors in closed form from the moments."""
    both = F.col("r").isNotNull() & F.col("rm").isNotNull() & F.col("z").isNotNull()
    y, a, b = (F.when(both, F.col(c)) for c in ("r", "rm", "z"))
    over = w.last_rows(n)
    cov = lambda p, q: F.covar_samp(p, q).over(over)
    k = F.count(y).over(over)
    saa, sbb, sab, say, sby, syy = cov(a, a), cov(b, b), cov(a, b), cov(a, y), cov(b, y), cov(y, y)
    det = saa * sbb - sab * sab
    two = F.try_divide(say * say * sbb - 2 * say * sby * sab + sby * sby * saa, F.when(det > 1e-18 * (saa * sbb + 1e-300), det))
    one = F.coalesce(F.try_divide(say * say, saa), F.lit(0.0))
    left = F.greatest(syy - F.coalesce(two, one), F.lit(0.0))
    whole = F.count("*").over(over) == n
    return F.when(whole & (k >= least), F.sqrt(left))


def rolling_z(x: Column, n: int = 252) -> Column:
    least = max(2, n // 4)
    return F.try_divide(x - w.mean(x, n, least), w.deviation(x, n, least))


def change(x: str, n: int, relative: bool) -> Column:
    """Over n rows: relative for prices, absolute for rates."""
    return F.try_divide(F.col(x), w.lag(x, n)) - 1 if relative else F.col(x) - w.lag(x, n)


def macro_beta(n: int = 60, least: int = 30) -> Column:
    """Beta of r on the factor f over the n rows before this one."""
    return w.beta(F.col("r"), F.col("f"), n, least, end=1)


def lagged_onto(calendar: DataFrame, series: DataFrame, rows: int) -> DataFrame:
    """Values as of each calendar day, then shifted by the release lag in rows of the calendar."""
    x = asof_join(calendar, series)
    cols = [c for c in series.columns if c not in ("sym", "d")]
    return x.select("sym", "d", *(w.lag(c, rows).alias(c) for c in cols))
