"""Revision features from a lake of daily snapshots, each row by what snapshots up to its day held.

A day counts when all of its endpoints were published whole. A symbol's snapshots become packed rows (all fiscal years of a
day in one array, with running counts of changes), and every question "what was the last snapshot by day x", for the day itself and for each
window's start, is a row of the same stream: one window by symbol answers them all, and differences of the running counts
tell the changes within any window, so no row meets the snapshots of its window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalars import business_days, consensus, drift, finite

ENDPOINTS = ["analyst_estimates", "price_target_consensus", "grades_consensus", "price_target_summary"]
#: Windows in business days; the second is the one whose exclusions are reported.
WINDOWS = {"5d": 5, "1m": 21, "3m": 63}
PRIMARY = "1m"


def published(manifests: DataFrame, endpoints: list[str] = ENDPOINTS) -> DataFrame:
    """manifests (as_of, endpoint, status, n_rows) -> the days on which every endpoint has a manifest that says "ok" and rows."""
    good = F.when((F.col("status") == "ok") & (F.col("n_rows") > 0) & F.col("endpoint").isin(endpoints), F.col("endpoint"))
    return manifests.groupBy("as_of").agg(F.countDistinct(good).alias("n")).where(F.col("n") == len(endpoints)).select("as_of")


def _packed(estimates: DataFrame) -> DataFrame:
    """(sym, as_of, snap): snap = (day, nth of the symbol's snapshots, years), years sorted by fiscal end, each with the counts
    of changes, rises and falls of its estimate up to this snapshot. Snapshots in which a year is absent count as no change."""
    fields = [F.coalesce(F.col(c).cast("double"), F.lit(None)).alias(c) for c in ("eps", "high", "low", "n_analysts")]
    rows = estimates.where("fiscal_end is not null").select("sym", "as_of", "fiscal_end", F.struct(*(finite(f).alias(c) for f, c in zip(fields, ("eps", "high", "low", "n_analysts"), strict=True))).alias("v"))
    rows = rows.groupBy("sym", "as_of", "fiscal_end").agg(F.max("v").alias("v"))  # the greatest of repeated rows
    w = Window.partitionBy("sym", "fiscal_end").orderBy("as_of")
    before, upto = F.lag("v").over(w), w.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("p", before)
    other = F.col("p").isNotNull() & ~F.col("p").eqNullSafe(F.col("v"))
    count = lambda c, name: F.sum(F.coalesce(c, F.lit(False)).cast("long")).over(upto).alias(name)
    rows = rows.select("sym", "as_of", "fiscal_end", "v", count(other, "changes"), count(F.col("v.eps") > F.col("p.eps"), "ups"), count(F.col("v.eps") < F.col("p.eps"), "downs"))
    years = rows.groupBy("sym", "as_of").agg(F.array_sort(F.collect_list(F.struct("fiscal_end", "v.eps", "v.n_analysts", "changes", "ups", "downs"))).alias("years"))  # a few for each snapshot
    nth = F.row_number().over(Window.partitionBy("sym").orderBy("as_of"))
    return years.select("sym", "as_of", F.struct(F.col("as_of").alias("day"), nth.alias("nth"), "years").alias("snap"))


def _target(snap: Column, day: Column) -> Column:
    """The first year of a snapshot that ends on ``day`` or later and has an estimate."""
    return F.get(F.filter(snap["years"], lambda y: (y["fiscal_end"] >= day) & y["eps"].isNotNull()), 0)


def revision_features(manifests: DataFrame, estimates: DataFrame, targets: DataFrame, grades: DataFrame) -> DataFrame:
    """The table of 19 columns: a row for each published day and symbol that any endpoint has shown by then.

    estimates (sym, as_of, fiscal_end, eps, high, low, n_analysts), targets (sym, as_of, target), grades (sym, as_of, strong_buy,
    buy, hold, sell, strong_sell). Of repeated rows of a key the greatest counts.
    """
    days = published(manifests)
    of = lambda df: df.join(days, "as_of", "left_semi")
    snaps = _packed(of(estimates))
    aims = of(targets).where(finite(F.col("target").cast("double")).isNotNull()).groupBy("sym", "as_of").agg(F.max(F.col("target").cast("double")).alias("target"))
    score = consensus(*(F.col(c).cast("double") for c in ("strong_buy", "buy", "hold", "sell", "strong_sell")))
    marks = of(grades).select("sym", "as_of", score.alias("grade")).where("grade is not null").groupBy("sym", "as_of").agg(F.max("grade").alias("grade"))
    seen = snaps.select("sym", "as_of").union(aims.select("sym", "as_of")).union(marks.select("sym", "as_of")).groupBy("sym").agg(F.min("as_of").alias("since"))
    calendar = days.agg(F.array_sort(F.collect_list("as_of")).alias("days"))  # one for each published day
    rows = seen.join(F.broadcast(calendar), F.lit(True)).select("sym", F.explode(F.filter("days", lambda x: x >= F.col("since"))).alias("as_of"))
    ask = [F.struct(F.lit("now").alias("which"), F.col("as_of").alias("at"))]
    ask += [F.struct(F.lit(k).alias("which"), business_days(F.col("as_of"), -n).alias("at")) for k, n in WINDOWS.items()]
    asked = rows.select("sym", "as_of", F.explode(F.array(*ask)).alias("q")).select("sym", F.col("q.at").alias("at"), "as_of", "q.which", F.lit(1).alias("_kind"))
    told = [x.withColumnRenamed("as_of", "at").withColumn("_kind", F.lit(0)) for x in (snaps, aims, marks)]
    stream = asked
    for x in told:
        stream = stream.unionByName(x, allowMissingColumns=True)
    w = Window.partitionBy("sym").orderBy("at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    known = stream.select("sym", "as_of", "which", "_kind", "at", *(F.last(c, ignorenulls=True).over(w).alias(c) for c in ("snap", "target", "grade"))).where("_kind = 1")
    answer = lambda k: F.max(F.when(F.col("which") == k, F.struct("at", "snap", "target", "grade"))).alias(f"_{k}")
    x = known.groupBy("sym", "as_of").agg(*map(answer, ["now", *WINDOWS]))
    x = x.withColumn("fy1", _target(F.col("_now.snap"), F.col("as_of")))
    out = {"symbol": F.col("sym"), "as_of": F.col("as_of"), "usable_from": business_days(F.col("as_of"), 1)}
    for name in WINDOWS:
        made = _window(F.col("_now.snap"), F.col(f"_{name}.snap"), F.col(f"_{name}.at"), F.col("fy1"))
        x = x.withColumn(f"w_{name}", made)
        out[f"revision_drift_{name}"] = F.col(f"w_{name}.drift")
    p, past = F.col(f"w_{PRIMARY}"), F.col(f"_{PRIMARY}")
    out |= {
        "revision_drift_1m_raw": p["raw"], "revision_breadth_1m": p["breadth"], "fy1_updated_1m": p["updated"], "fy1_rolled_1m": p["rolled"],
        "n_est_snapshots_1m": p["n_snaps"], "fy1_eps_avg_lag_1m": p["lag_eps"], "excluded_1m": p["drift"].isNull(), "excluded_reason_1m": p["reason"],
        "fy1_fiscal_end": F.col("fy1.fiscal_end"), "fy1_eps_avg": F.col("fy1.eps"), "fy1_num_analysts": F.col("fy1.n_analysts"),
        "target_drift_1m": drift(F.col("_now.target"), past["target"]), "grade_migration_1m": F.col("_now.grade") - past["grade"],
    }
    return x.select(*(c.alias(k) for k, c in out.items()))


def _window(now: Column, then: Column, start: Column, fy1: Column) -> Column:
    """Drift and its exclusions over one window, for the same fiscal year at both ends."""
    old = F.get(F.filter(then["years"], lambda y: y["fiscal_end"] == fy1["fiscal_end"]), 0)
    raw = drift(fy1["eps"], old["eps"])
    whole = old["eps"].isNotNull()  # both ends are known
    between = lambda c: fy1[c] - old[c]
    up, down, updated = between("ups"), between("downs"), between("changes") > 0
    reason = (
        F.when(now.isNull(), "no_snapshot").when(fy1.isNull(), "no_fy1").when(then.isNull(), "no_lag_snapshot").when(~whole | old.isNull(), "no_fy1_row_at_lag")
        .when(raw.isNull(), "zero_denominator").when(~updated, "no_update_in_window").otherwise("")
    )
    first = _target(then, start)["fiscal_end"]
    return F.struct(
        F.when(updated, raw).alias("drift"),
        raw.alias("raw"),
        F.when(whole, F.try_divide((up - down).cast("double"), up + down)).alias("breadth"),
        F.coalesce(whole & updated, F.lit(False)).alias("updated"),
        F.coalesce(whole & (first != fy1["fiscal_end"]), F.lit(False)).alias("rolled"),
        F.when(whole, now["nth"] - then["nth"] + F.when(then["day"] == start, 1).otherwise(0)).otherwise(0).cast("long").alias("n_snaps"),
        F.when(whole, old["eps"]).alias("lag_eps"),
        reason.alias("reason"),
    )


def readiness(manifests: DataFrame) -> DataFrame:
    """One row: the first published day, when its features may first be judged (six and nine months on, the month's last day
    where it has none such), and when each window is first full."""
    first = published(manifests).agg(F.min("as_of").alias("anchor"))
    full = [business_days(F.col("anchor"), n).alias(f"mature_{k}") for k, n in WINDOWS.items()]
    return first.select("anchor", F.add_months("anchor", 6).alias("confirmatory_unlock"), F.add_months("anchor", 9).alias("second_checkpoint"), *full)


def exclusions(features: DataFrame) -> DataFrame:
    """(as_of, n, excluded): the share of each day's symbols that the primary window excludes."""
    return features.groupBy("as_of").agg(F.count("*").alias("n"), F.avg(F.col("excluded_1m").cast("double")).alias("excluded"))


def unpublished_weekdays(manifests: DataFrame) -> DataFrame:
    """Weekdays between the first and the last published day that were not published themselves."""
    days = published(manifests)
    span = days.agg(F.min("as_of").alias("a"), F.max("as_of").alias("z")).where("a is not null")
    every = span.select(F.explode(F.sequence("a", "z")).alias("as_of")).where(F.weekday("as_of") < 5)
    return every.join(days, "as_of", "left_anti")
