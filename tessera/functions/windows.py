"""Gated rolling windows over (sym, d): a result only where enough observations are not null."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def series() -> WindowSpec:
    """A symbol's rows in time order."""
    return Window.partitionBy("sym").orderBy("d")


def so_far() -> WindowSpec:
    return series().rowsBetween(Window.unboundedPreceding, 0)


def day() -> WindowSpec:
    """All symbols of a day."""
    return Window.partitionBy("d")


def last_rows(n: int) -> WindowSpec:
    """The current row and the n - 1 before it."""
    return series().rowsBetween(1 - n, 0)


def lag(x: Column | str, n: int = 1) -> Column:
    return F.lag(x, n).over(series())


def lead(x: Column | str, n: int = 1) -> Column:
    return F.lead(x, n).over(series())


def rolled(x: Column, n: int, agg: Callable[[Column], Column], least: int | None = None, over: WindowSpec | None = None) -> Column:
    """``agg`` of the last n rows where ``least`` (n unless given) of them are not null."""
    w = over if over is not None else last_rows(n)
    return F.when(F.count(x).over(w) >= (n if least is None else least), agg(x).over(w))


def mean(x: Column, n: int, least: int | None = None) -> Column:
    return rolled(x, n, F.avg, least)


def deviation(x: Column, n: int, least: int | None = None) -> Column:
    return rolled(x, n, F.stddev_samp, least)


def total(x: Column, n: int, least: int | None = None) -> Column:
    return rolled(x, n, F.sum, least)


def at_least_zero(x: Column) -> Column:
    """Keeps null; greatest() alone would skip it."""
    return F.when(x.isNotNull(), F.greatest(x, F.lit(0.0)))


def correlation(x: Column, y: Column, n: int) -> Column:
    """Null where a leg is constant: corr() would divide by zero. Both legs are masked to their common rows."""
    both = x.isNotNull() & y.isNotNull()
    x, y, w = F.when(both, x), F.when(both, y), last_rows(n)
    spread = F.sqrt(F.var_samp(x).over(w) * F.var_samp(y).over(w))
    return F.when(F.count(x).over(w) == n, F.try_divide(F.covar_samp(x, y).over(w), spread))


def beta(y: Column, x: Column, n: int, least: int | None = None, end: int = 0) -> Column:
    """Slope of y on x over the n rows that end ``end`` rows ago, from common rows."""
    both = y.isNotNull() & x.isNotNull()
    y, x = F.when(both, y), F.when(both, x)
    w = series().rowsBetween(1 - n - end, -end)
    return F.when(F.count(x).over(w) >= (least or n), F.try_divide(F.covar_samp(y, x).over(w), F.var_samp(x).over(w)))


def arg_extreme(x: Column, n: int, largest: bool) -> Column:
    """Place (0 the oldest) of the first largest or smallest of the last n values."""
    values, pick = rolled(x, n, F.collect_list), F.array_max if largest else F.array_min
    return (F.array_position(values, pick(values)) - 1).cast("double")


def rank_average(x: Column, n: int) -> Column:
    """Rank of the current value among the last n over n; ties share their average rank."""
    a = rolled(x, n, F.collect_list)
    below, same = F.size(F.filter(a, lambda v: v < x)), F.size(F.filter(a, lambda v: v == x))
    return F.when(a.isNotNull(), (below + (same + 1).cast("double") / 2) / n)


def rank_top(x: Column, n: int) -> Column:
    """Share of the last n values up to the current one: ties take the highest rank."""
    a = rolled(x, n, F.collect_list)
    return F.when(a.isNotNull(), F.size(F.filter(a, lambda v: v <= x)).cast("double") / n)


def quantile(x: Column, n: int, q: float) -> Column:
    return rolled(x, n, lambda c: F.percentile(c, q))
