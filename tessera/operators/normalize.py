"""Cross-sections per day and statistics fitted on a training window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.windows import day


def label_z(x: Column) -> Column:
    """Z-score within the day; null with one name."""
    return (x - F.avg(x).over(day())) / (F.stddev_samp(x).over(day()) + 1e-12)


def median_fill(x: Column) -> Column:
    return F.coalesce(x, F.median(x).over(day()), F.lit(0.0))


def percent_rank_average(df: DataFrame, column: str, out: str) -> DataFrame:
    """Rank within the day over the number of known values, ties averaged, nulls kept."""
    by_value = day().orderBy(F.col(column).asc_nulls_last())
    r = F.rank().over(by_value).cast("double")
    same = F.count(column).over(day().orderBy(column).rangeBetween(0, 0)).cast("double")
    return df.withColumn(out, F.when(F.col(column).isNotNull(), (r + (same - 1) / 2) / F.count(column).over(day())))


def train_clip_z(df: DataFrame, columns: list[str], train: Column, tails: float = 0.001, most: float = 5.0) -> DataFrame:
    """Clips to the training quantiles, standardises by the clipped training mean and deviation, null to 0, clips to
    +-most. Two aggregates of one row each; they meet the panel by a broadcast of that row."""
    lo, hi, mean, sd = ({c: f"_{k}_{c}" for c in columns} for k in ("lo", "hi", "mean", "sd"))
    bounds = df.where(train).agg(*(F.percentile(c, q).alias(f"_{k}_{c}") for c in columns for k, q in (("lo", tails), ("hi", 1 - tails))))

    def clipped(x: DataFrame) -> DataFrame:
        x = x.join(F.broadcast(bounds), F.lit(True))  # one row
        inside = {c: F.when((F.col(hi[c]) > F.col(lo[c])) & F.col(c).isNotNull(), F.least(F.greatest(c, lo[c]), hi[c])).otherwise(F.col(c)) for c in columns}
        return x.withColumns(inside).select(*df.columns)

    stats = clipped(df.where(train)).agg(*(f(c).alias(f"_{k}_{c}") for c in columns for k, f in (("mean", F.avg), ("sd", F.stddev_samp))))
    out = clipped(df).join(F.broadcast(stats), F.lit(True))
    z = lambda c: (F.col(c) - F.col(mean[c])) / F.when(F.col(sd[c]) > 1e-9, F.col(sd[c])).otherwise(1.0)
    return out.withColumns({c: F.least(F.greatest(F.coalesce(z(c), F.lit(0.0)), F.lit(-most)), F.lit(most)) for c in columns}).select(*df.columns)


def robust_z(df: DataFrame, column: str, train: Column, out: str, most: float = 3.0) -> DataFrame:
    """(x - median) / (1.4826 MAD) with both from the training rows, as one-row tables that are joined; null to 0."""
    med = F.broadcast(df.where(train).agg(F.median(column).alias("_med")))
    mad = F.broadcast(df.where(train).join(med, F.lit(True)).agg(F.median(F.abs(F.col(column) - F.col("_med"))).alias("_mad")))
    x = df.join(med, F.lit(True)).join(mad, F.lit(True))
    z = (F.col(column) - F.col("_med")) / F.greatest(1.4826 * F.coalesce("_mad", F.lit(0.0)), F.lit(1e-9))
    return x.withColumn(out, F.least(F.greatest(F.coalesce(z, F.lit(0.0)), F.lit(-most)), F.lit(most))).drop("_med", "_mad")
