"""Panels of several tables, with the guards that keep joins from changing them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import windows as w
from tessera.operators.asof import asof_join


def _counted(df: DataFrame, keys: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.count("*").alias("_copies"), F.min(F.struct(*rest)).alias("_row"))


def _once(df: DataFrame) -> DataFrame:
    """The job fails where a key has copies. The check is a filter over the counts, so neither its columns nor the join that
    brought them can be pruned, whatever is read afterwards."""
    many = F.when(F.col("_copies") > 1, F.raise_error(F.concat(F.lit("rows of one key: "), F.col("_copies").cast("string"))))
    return df.where(many.cast("boolean").isNull())


def unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with one row for each key; the job fails where there are more."""
    rest = [c for c in df.columns if c not in keys]
    return _once(_counted(df, keys)).select(*keys, *(F.col(f"_row.{c}").alias(c) for c in rest))


def single(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df``, whose keys are distinct; the job fails where one is not. Rows are counted beside each other, not packed."""
    return _once(df.withColumn("_copies", F.count("*").over(Window.partitionBy(*keys)))).select(*df.columns)


def attach(panel: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Left join that can't change the panel's rows: ``other`` must have one row for each key that the panel has."""
    rest = [c for c in other.columns if c not in keys]
    x = _once(panel.join(_counted(other, keys), keys, "left"))
    return x.select(*panel.columns, *(F.col(f"_row.{c}").alias(c) for c in rest))


def split_labels(panel: DataFrame, splits: DataFrame) -> DataFrame:
    """Adds ``split``, that of the row's day; the first label of a day (in order of symbol) counts, other days are test."""
    first = splits.groupBy("d").agg(F.min_by("split", "sym").alias("split"))
    return panel.join(first, "d", "left").withColumn("split", F.coalesce("split", F.lit("test")))


def labelled(features: DataFrame, labels: DataFrame, needed: list[str]) -> DataFrame:
    """Features with labels; rows without one of the ``needed`` go before any statistic is fitted."""
    return features.join(labels, ["sym", "d"]).dropna(subset=needed)


def train_standardised(panel: DataFrame, features: list[str], tails: float = 0.001, most: float = 5.0) -> DataFrame:
    """Infinite values to null, clipped to the training quantiles, standardised by the clipped training mean and deviation,
    null to 0, clipped to +-most. Statistics are one-row tables that are joined, so nothing runs before the result does."""
    finite = panel.withColumns({c: F.when(~F.isnan(c) & (F.abs(F.col(c)) != float("inf")), F.col(c)) for c in features})
    train = finite.where("split = 'train'")
    bounds = train.agg(*(F.percentile(c, F.lit(q)).alias(f"_{k}_{c}") for c in features for k, q in (("lo", tails), ("hi", 1 - tails))))

    def clipped(df: DataFrame) -> DataFrame:
        x = df.join(F.broadcast(bounds), F.lit(True))  # one row
        wide = lambda c: F.col(f"_hi_{c}") > F.col(f"_lo_{c}")
        inside = {c: F.when(wide(c) & F.col(c).isNotNull(), F.least(F.greatest(c, f"_lo_{c}"), f"_hi_{c}")).otherwise(F.col(c)) for c in features}
        return x.withColumns(inside).select(*df.columns)

    stats = clipped(train).agg(*(f(c).alias(f"_{k}_{c}") for c in features for k, f in (("mean", F.avg), ("sd", F.stddev_samp))))
    out = clipped(finite).join(F.broadcast(stats), F.lit(True))
    z = lambda c: (F.col(c) - F.col(f"_mean_{c}")) / F.when(F.col(f"_sd_{c}") > 1e-9, F.col(f"_sd_{c}")).otherwise(1.0)
    return out.withColumns({c: F.least(F.greatest(F.coalesce(z(c), F.lit(0.0)), F.lit(-most)), F.lit(most)) for c in features}).select(*panel.columns)


def train_history(panel: DataFrame, features: list[str], least: int = 252) -> DataFrame:
    """feature, n, enough: finite training values of each feature against the number that is needed."""
    train = panel.where("split = 'train'")
    one = train.agg(*(F.count(F.when(~F.isnan(c) & (F.abs(F.col(c)) != float("inf")), 1)).alias(c) for c in features))
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).alias("n")) for c in features)))
    return one.select(rows.alias("x")).select("x.*").withColumn("enough", F.col("n") >= least)


def daily_ratios(bars: DataFrame, shares: DataFrame) -> DataFrame:
    """bars (sym, d, c) with the market capitalisation by the shares (sym, d, shares, earnings, book) known on the day, and
    earnings and book over it; symbols without any report are left out."""
    known = bars.join(shares.select("sym").distinct(), "sym", "left_semi")
    x = asof_join(known.select("sym", "d", "c"), shares).withColumn("market_cap", F.col("shares") * F.col("c"))
    ratio = lambda c: F.when(F.col("market_cap") > 0, F.try_divide(c, "market_cap"))
    return x.select("sym", "d", "market_cap", ratio("earnings").alias("earnings_yield"), ratio("book").alias("book_to_price"))


def inverse(x: Column) -> Column:
    """1 / x of positive x only."""
    return F.when(x > 0, 1 / x)


def year_on_year(x: Column, rows: int = 4) -> Column:
    """Change over ``rows`` rows of a symbol (quarters), in order of ``d``."""
    return F.try_divide(x, w.lag(x, rows)) - 1


def filled_calendar(df: DataFrame, columns: list[str], rows: int) -> DataFrame:
    """Every day between a symbol's first and last; a gap takes the last known value, ``rows`` days on at most."""
    span = df.groupBy("sym").agg(F.min("d").alias("a"), F.max("d").alias("z"))
    days = span.select("sym", F.explode(F.sequence("a", "z")).alias("d"))
    x = days.join(df, ["sym", "d"], "left")
    limited = Window.partitionBy("sym").orderBy("d").rowsBetween(-rows, 0)
    return x.select("sym", "d", *(F.last(c, ignorenulls=True).over(limited).alias(c) for c in columns))


def missing(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Expected keys that the actual table lacks."""
    return expected.select(*keys).distinct().join(actual.select(*keys), keys, "left_anti")


def option_surface(contracts: DataFrame, as_of: Column, spot: Column) -> DataFrame:
    """Per root: at-the-money volatilities of calls and puts near 30 and 60 days, the 30-day skew (put less call) and the
    term structure (60-day mean less 30-day mean; where a put is missing, the call alone)."""
    from tessera.operators.screen import nearest_atm

    known = contracts.where("iv > 0")
    parts = [nearest_atm(known, as_of, spot, n).groupBy("root").agg(F.max(F.when(F.col("kind") == "C", F.col("iv"))).alias(f"call_{n}"), F.max(F.when(F.col("kind") == "P", F.col("iv"))).alias(f"put_{n}")) for n in (30, 60)]
    x = parts[0].join(parts[1], "root", "full_outer")
    mean = lambda n: F.coalesce((F.col(f"call_{n}") + F.col(f"put_{n}")) / 2, F.col(f"call_{n}"))
    return x.withColumns({"skew_30": F.col("put_30") - F.col("call_30"), "term": mean(60) - mean(30)})


def universe_hash(symbols: DataFrame) -> DataFrame:
    """One row: SHA-256 of the distinct symbols in upper case, whatever their order or number of copies; and their number."""
    one = symbols.select(F.upper(F.trim("sym")).alias("s")).distinct()
    return one.agg(F.sha2(F.concat_ws(",", F.array_sort(F.collect_list("s"))), 256).alias("universe_sha256"), F.count("*").alias("n"))  # a list of names


def future_rows(df: DataFrame, today: Column) -> DataFrame:
    """The last day, and the rows after ``today``; a table with any is not served."""
    return df.agg(F.max("d").alias("last"), F.count(F.when(F.col("d") > today, 1)).alias("n_future"))
