"""Bitemporal estimate revisions: what a snapshot knew of the same fiscal target some business days ago."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalars import business_days, drift
from tessera.operators.asof import asof_join


def revisions(snaps: DataFrame, lag: int = 20) -> DataFrame:
    """snaps (sym, as_of, fiscal_end, eps) -> per (sym, as_of): the nearest fiscal end from as_of on in that snapshot, its
    eps, the eps that the latest snapshot ``lag`` business days earlier had for it, their drift, changes within the
    window (up, down, breadth), why a drift is missing, and the day from which the row may be used."""
    ahead = snaps.where(F.col("eps").isNotNull() & (F.col("fiscal_end") >= F.col("as_of")))
    first = ahead.groupBy("sym", "as_of").agg(F.min(F.struct("fiscal_end", "eps")).alias("x")).select("sym", "as_of", "x.*")
    days = snaps.select("sym", "as_of").distinct().join(first, ["sym", "as_of"], "left").withColumn("then", business_days(F.col("as_of"), -lag))
    known = snaps.select("sym", F.col("as_of").alias("d"), F.col("as_of").alias("lag_snap")).distinct()
    x = asof_join(days.withColumn("d", F.col("then")), known).drop("d")
    old = snaps.select("sym", F.col("as_of").alias("lag_snap"), "fiscal_end", F.col("eps").alias("eps_lag"))
    x = x.join(old, ["sym", "lag_snap", "fiscal_end"], "left")
    s = Window.partitionBy("sym", "fiscal_end").orderBy("as_of")
    moves = snaps.where("eps is not null").withColumn("_p", F.lag("eps").over(s))
    cum = s.rowsBetween(Window.unboundedPreceding, 0)
    # running counts of moves, so a window's moves are a difference and no row meets a range of others
    moves = moves.select("sym", "fiscal_end", "as_of", F.sum((F.col("eps") > F.col("_p")).cast("int")).over(cum).alias("u"), F.sum((F.col("eps") < F.col("_p")).cast("int")).over(cum).alias("v"))
    now = moves.select("sym", "fiscal_end", "as_of", F.coalesce("u", F.lit(0)).alias("u1"), F.coalesce("v", F.lit(0)).alias("v1"))
    was = moves.select("sym", "fiscal_end", F.col("as_of").alias("lag_snap"), F.coalesce("u", F.lit(0)).alias("u0"), F.coalesce("v", F.lit(0)).alias("v0"))
    x = x.join(now, ["sym", "fiscal_end", "as_of"], "left").join(was, ["sym", "fiscal_end", "lag_snap"], "left")
    up, down = F.col("u1") - F.col("u0"), F.col("v1") - F.col("v0")
    reason = (
        F.when(F.col("fiscal_end").isNull(), "no_fy1")
        .when(F.col("lag_snap").isNull(), "no_lag_snapshot")
        .when(F.col("eps_lag").isNull(), "no_fy1_row_at_lag")
        .when(F.col("eps_lag") == 0, "zero_denominator")
        .when(up + down == 0, "no_update_in_window")
    )
    return x.select("sym", "as_of", "fiscal_end", "eps", "eps_lag", drift(F.col("eps"), F.col("eps_lag")).alias("eps_drift"), up.cast("long").alias("n_up"), down.cast("long").alias("n_down"), F.try_divide((up - down).cast("double"), up + down).alias("breadth"), reason.alias("reason"), business_days(F.col("as_of"), 1).alias("usable_from"))
