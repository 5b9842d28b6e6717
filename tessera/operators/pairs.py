"""The panel of pairs that trade every day: serving-grain features, forward returns by calendar day, and when each label is known."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import rolling

HORIZONS = (1, 5, 20)


def closes(bars: DataFrame) -> DataFrame:
    """``bars`` with ``bar_close``: the stored one, else the midnight after the day."""
    day_after = F.date_add("d", 1).cast("timestamp")
    return bars.withColumn("bar_close", F.coalesce("bar_close", day_after) if "bar_close" in bars.columns else day_after)


def labels(bars: DataFrame, benchmark: str, horizons: tuple[int, ...] = HORIZONS) -> DataFrame:
    """(sym, d, fwd_<n>d, available_after_<n>d, and both for the excess over the benchmark). A return needs a bar exactly n days later;
    it is known when that bar closes. An excess needs the benchmark's bars of both days and is known when the later of the two last bars
    closes; the benchmark itself has none."""
    own = bars.select("sym", "d", "c", "bar_close")
    ends = F.explode(F.array(*(F.struct(F.lit(n).alias("n"), F.date_sub("d", n).alias("d0")) for n in horizons)))
    ahead = own.select("sym", "c", "bar_close", ends.alias("x")).select("sym", F.col("x.d0").alias("d"), "x.n", F.struct(F.col("c").alias("c1"), "bar_close").alias("end"))
    wide = ahead.groupBy("sym", "d").agg(*(F.max(F.when(F.col("n") == n, F.col("end"))).alias(f"e{n}") for n in horizons))
    x = own.drop("bar_close").join(wide, ["sym", "d"], "left")
    fwd = lambda n: F.try_divide(F.col(f"e{n}.c1"), "c") - 1
    x = x.select("sym", "d", *(fwd(n).alias(f"fwd_{n}d") for n in horizons), *(F.when(fwd(n).isNotNull(), F.col(f"e{n}.bar_close")).alias(f"available_after_{n}d") for n in horizons))
    base = x.where(F.col("sym") == benchmark).select("d", *(F.col(f"fwd_{n}d").alias(f"b{n}") for n in horizons), *(F.col(f"available_after_{n}d").alias(f"a{n}") for n in horizons))
    x = x.join(base, "d", "left")
    both = lambda n: F.when((F.col("sym") != benchmark) & F.col(f"b{n}").isNotNull(), F.col(f"fwd_{n}d") - F.col(f"b{n}"))
    late = lambda n: F.when(both(n).isNotNull(), F.greatest(f"available_after_{n}d", f"a{n}"))
    return x.select("sym", "d", *(c for n in horizons for c in (F.col(f"fwd_{n}d"), F.col(f"available_after_{n}d"), both(n).alias(f"fwd_{n}d_excess"), late(n).alias(f"excess_available_after_{n}d"))))


def panel(bars: DataFrame, benchmark: str, problems: DataFrame | None = None, least_pairs: int = 2, least_days: int = 60, only: set[str] | None = None, horizons: tuple[int, ...] = HORIZONS) -> DataFrame:
    """Features and labels of bars (sym, d, o h l c v, bar_close if known) with the day each row's bar closes. ``problems`` (sym, problem)
    is the manifest's verdict: the job fails on a symbol whose bars may not be used or that has none. It also fails with fewer than
    ``least_pairs`` symbols or ``least_days`` days. ``only``: some of the feature families."""
    bars = closes(bars)
    if problems is not None:
        sealed = problems.groupBy("sym").agg(F.max(F.coalesce("problem", F.lit(""))).alias("_problem"))
        bad = F.coalesce("_problem", F.lit("no verdict"))
        x = bars.join(sealed, "sym", "left")
        bars = x.where(F.when(bad != "", F.raise_error(F.concat("sym", F.lit(": "), bad))).cast("boolean").isNull()).drop("_problem")
    out = rolling.features(bars, "serve", only).join(labels(bars, benchmark, horizons), ["sym", "d"]).join(bars.select("sym", "d", "bar_close"), ["sym", "d"], "left")
    size = out.agg(F.countDistinct("sym").alias("_pairs"), F.countDistinct("d").alias("_days"))  # one row
    few = F.when((F.col("_pairs") < least_pairs) | (F.col("_days") < least_days), F.raise_error(F.concat_ws(" ", F.lit("too few symbols or days:"), F.col("_pairs").cast("string"), F.col("_days").cast("string"))))
    return out.join(F.broadcast(size), F.lit(True)).where(few.cast("boolean").isNull()).drop("_pairs", "_days")
