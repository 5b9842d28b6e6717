"""Point-in-time fundamentals from entity-attribute-value facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.asof import asof_join

FALLBACK_LAG_DAYS = 60


def latest_pivot(facts: DataFrame, concepts: list[str]) -> DataFrame:
    """Per (sym, period_end) each concept's value that was filed last; an undated filing counts as the last of all.
    Static concepts, so the pivot needs no pass to find them. available: last filing day used, by tier else period end
    plus FALLBACK_LAG_DAYS."""
    key = F.struct(F.col("filed").isNull().alias("undated"), "filed", "event_id", "val")
    known = facts.where(F.col("val").isNotNull() & F.col("concept").isin(concepts))
    last = known.groupBy("sym", "period_end", "concept").agg(F.max(key).alias("x"))
    wide = last.groupBy("sym", "period_end").agg(*(F.max(F.when(F.col("concept") == c, F.col("x.val"))).alias(c) for c in concepts), F.max("x.filed").alias("filed"))
    fallback = F.date_add("period_end", FALLBACK_LAG_DAYS)
    source = F.when(F.col("filed").isNotNull(), "filed").otherwise("fallback")
    return wide.withColumns({"available": F.coalesce(F.col("filed").cast("date"), fallback), "source": source}).drop("filed")


def carry_forward(wide: DataFrame, concepts: list[str], known: bool = False) -> DataFrame:
    """Each concept's last known value in order of availability; then the last row of each availability day. ``known``:
    with the day each value became available, as <concept>_known."""
    w = Window.partitionBy("sym").orderBy("available", "period_end").rowsBetween(Window.unboundedPreceding, 0)
    days = [F.last(F.when(F.col(c).isNotNull(), F.col("available")), ignorenulls=True).over(w).alias(f"{c}_known") for c in concepts if known]
    filled = wide.select("sym", "available", "period_end", *(F.last(c, ignorenulls=True).over(w).alias(c) for c in concepts), *days)
    last = filled.groupBy("sym", "available").agg(F.max(F.struct("period_end", *filled.columns[3:])).alias("x"))
    return last.select("sym", F.col("available").alias("d"), "x.*")


def to_daily(carried: DataFrame, calendar: DataFrame) -> DataFrame:
    """The values known on each (sym, d) of the calendar."""
    return asof_join(calendar, carried)


def point_in_time_violations(df: DataFrame) -> DataFrame:
    """Rows that were used before they were known, or known before their period ended."""
    early, odd = F.col("available") > F.col("d"), F.col("period_end") > F.col("available")
    return df.agg(F.count(F.when(early, 1)).alias("used_before_known"), F.count(F.when(odd, 1)).alias("known_before_end"), F.count("*").alias("n_rows"))


def used_early(daily: DataFrame, concepts: list[str]) -> DataFrame:
    """Rows of the daily panel with a value that became available after the row's day."""
    early = F.greatest(*(F.col(f"{c}_known") for c in concepts)) > F.col("d")
    return daily.agg(F.count(F.when(early, 1)).alias("used_before_known"))


def coverage(df: DataFrame, features: list[str], universe: DataFrame) -> DataFrame:
    """Long report of the last day: known values over the symbols of the universe, over the day's symbols, over symbols ever seen."""
    last = df.agg(F.max("d").alias("last"))
    today = df.join(F.broadcast(last), F.col("d") == F.col("last"))
    ever = df.select("sym").distinct().agg(F.count("*").alias("ever"))
    one = today.agg(F.count("*").alias("n_today"), *(F.count(c).alias(c) for c in features)).join(F.broadcast(ever), F.lit(True)).join(F.broadcast(universe.agg(F.countDistinct("sym").alias("universe"))), F.lit(True))  # one row each
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).alias("n")) for c in features)))
    ratio = lambda den: F.try_divide(F.col("n").cast("double"), den)
    return one.select("n_today", "ever", "universe", rows.alias("x")).select("x.*", "n_today", "ever", "universe").select("feature", "n", ratio(F.col("universe")).alias("of_universe"), ratio(F.col("n_today")).alias("of_today"), ratio(F.col("ever")).alias("of_ever"))


def derive_fourth(quarters: DataFrame, annual: DataFrame) -> DataFrame:
    """Adds a fourth quarter where a year has three: the annual value less them. quarters / annual: sym, start, end, val."""
    inside = quarters.select("sym", F.col("end").alias("qe"), F.col("start").alias("qs"), "val").join(annual.select("sym", F.col("start").alias("as_"), F.col("end").alias("ae"), F.col("val").alias("year")), "sym").where("qs >= date_sub(as_, 20) and qe < ae and qs >= date_sub(ae, 366)")
    three = inside.groupBy("sym", "as_", "ae", "year").agg(F.count("*").alias("n"), F.sum("val").alias("s"), F.max("qe").alias("last")).where("n = 3")
    made = three.select("sym", F.date_add("last", 1).alias("start"), F.col("ae").alias("end"), (F.col("year") - F.col("s")).alias("val"))
    return quarters.select("sym", "start", "end", "val").unionByName(made.join(quarters.select("sym", F.col("end")), ["sym", "end"], "left_anti"))


def trailing_year(quarters: DataFrame, annual: DataFrame) -> DataFrame:
    """Sum of the last four quarters where they span 330 to 400 days; an annual value for the same end wins."""
    q = derive_fourth(quarters, annual)
    w = Window.partitionBy("sym").orderBy("end").rowsBetween(-3, 0)
    span = F.datediff("end", F.min("start").over(w)) + 1
    ttm = q.select("sym", "end", F.when((F.count("val").over(w) == 4) & span.between(330, 400), F.sum("val").over(w)).alias("ttm"))
    both = ttm.join(annual.groupBy("sym", "end").agg(F.max("val").alias("year")), ["sym", "end"], "full_outer")
    return both.select("sym", "end", F.coalesce("year", "ttm").alias("ttm")).where("ttm is not null")


def growth(x: Column, rows: int) -> Column:
    """Change over rows of a symbol after padding its gaps with the last known value, clipped to [-0.99, 5]."""
    w = Window.partitionBy("sym").orderBy("d")
    padded = lambda end: F.last(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, end))
    r = F.try_divide(padded(0), padded(-rows)) - 1
    return F.when(r.isNotNull(), F.least(F.greatest(r, F.lit(-0.99)), F.lit(5.0)))
