"""As-of joins in one shuffle: both sides in one stream per key, each left row taking the last right row before it.

Nothing compares all pairs of a key, and any number of right tables can be carried in one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, by: str | None = "sym", on: str = "d", *, exact: bool = True, days: int | None = None, rows: int | None = None, prefix: str = "", rows_of: str = "sym") -> DataFrame:
    """left with the columns of the latest right row at or before its ``on`` (strictly before unless ``exact``).

    ``days``: null if the match is older; ``rows``: null if more left rows than that lie between. Equal right times keep
    the greatest row. ``by`` None matches one series to all keys, by left's distinct times; ``rows`` then count those of each
    ``rows_of``.
    """
    right_cols = [c for c in right.columns if c not in (by, on)]
    packed = right.groupBy(*([by] if by else []), on).agg(F.max(F.struct(F.col(on).alias("_at"), *right_cols)).alias("_r"))
    if by is None:
        return _broadcasting(left, packed, on, exact, days, rows, right_cols, prefix, rows_of)
    l = left.withColumns({"_r": F.lit(None).cast(packed.schema["_r"].dataType), "_left": F.lit(1)})
    both = l.unionByName(packed.withColumn("_left", F.lit(0)), allowMissingColumns=True)
    first = F.col("_left").asc() if exact else F.col("_left").desc()
    w = Window.partitionBy(by).orderBy(on, first).rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("_m", F.last("_r", ignorenulls=True).over(w))
    return _finished(out, left, on, by, days, rows, right_cols, prefix)


def _finished(out: DataFrame, left: DataFrame, on: str, by: str, days, rows, cols: list[str], prefix: str) -> DataFrame:
    out = out.where("_left = 1")
    ok = F.lit(True)
    if days is not None:
        ok = ok & (F.datediff(on, F.col("_m._at")) <= days)
    if rows is not None:
        since = F.count("*").over(Window.partitionBy(by, F.col("_m._at")).orderBy(on).rowsBetween(Window.unboundedPreceding, 0))
        fresh = F.count(F.when(F.col("_m._at") == F.col(on), 1)).over(Window.partitionBy(by, F.col("_m._at")))
        out = out.withColumn("_since", since - F.when(fresh > 0, 1).otherwise(0))
        ok = ok & (F.col("_since") <= rows)
    return out.select(*left.columns, *(F.when(ok, F.col(f"_m.{c}")).alias(f"{prefix}{c}") for c in cols))


def _broadcasting(left: DataFrame, packed: DataFrame, on: str, exact: bool, days, rows, cols: list[str], prefix: str, rows_of: str) -> DataFrame:
    """One series for all keys: matched to left's distinct times first, so it is never copied to every key."""
    times = left.select(on).distinct().withColumn("_one", F.lit(0))
    series = packed.withColumn("_one", F.lit(0)).select("_one", on, "_r.*").drop("_at")
    at = asof_join(times, series.withColumn("_mt", F.col(on)), "_one", on, exact=exact).drop("_one")
    keyed = at.select(F.col(on).alias("_t"), F.col("_mt"), *(F.col(c).alias(f"_c_{c}") for c in cols))
    out = left.join(keyed, left[on] == F.col("_t"), "left")
    ok = F.lit(True)
    if days is not None:
        ok = ok & (F.datediff(on, "_mt") <= days)
    if rows is not None:
        w = Window.partitionBy(rows_of, "_mt").orderBy(on).rowsBetween(Window.unboundedPreceding, 0)
        hit = F.max((F.col("_mt") == F.col(on)).cast("int")).over(Window.partitionBy(rows_of, "_mt"))
        out = out.withColumn("_since", F.count("*").over(w) - hit)
        ok = ok & (F.col("_since") <= rows)
    return out.select(*(left[c] for c in left.columns), *(F.when(ok, F.col(f"_c_{c}")).alias(f"{prefix}{c}") for c in cols))
