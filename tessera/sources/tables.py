"""Domain tables read from stored ones: scans, adapters, upserts and watermarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_range(store: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows of (sym, d) within [start, end], the last ingested of each key; ``seq`` orders ingestion."""
    df = store
    if start is not None:
        df = df.where(F.col("d") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("d") <= F.lit(end).cast("date"))
    return keep_last(df, ["sym", "d"], "seq")


def keep_last(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The row of each key with the highest ``seq``. Equal sequence numbers are broken by the whole row."""
    rest = [c for c in df.columns if c not in (*keys, seq)]
    best = df.groupBy(*keys).agg(F.max(F.struct(seq, *rest)).alias("_x"))
    return best.select(*keys, *(F.col(f"_x.{c}").alias(c) for c in (seq, *rest))).select(*df.columns)


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old and new by name; new rows win. One grouped pass, no sort of a key's rows."""
    both = old.withColumn("_gen", F.lit(0)).unionByName(new.withColumn("_gen", F.lit(1)), allowMissingColumns=True)
    return keep_last(both, keys, "_gen").drop("_gen")


def bars_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sym (brand), d (ship day), o h l c v from trades in a fixed order within the day."""
    trades = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("sym")), F.col("l_partkey") == F.col("p_partkey"))
    px = F.try_divide("l_extendedprice", "l_quantity")
    k = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax")
    days = trades.select("sym", F.col("l_shipdate").cast("date").alias("d"), px.alias("px"), k.alias("k"), "l_quantity")
    days = days.groupBy("sym", "d").agg(F.min(F.struct("k", "px")).alias("first"), F.max(F.struct("k", "px")).alias("last"), F.max("px").alias("h"), F.min("px").alias("l"), F.sum("l_quantity").alias("v"))
    return days.select("sym", "d", F.col("first.px").alias("o"), "h", "l", F.col("last.px").alias("c"), "v")


def market_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(d, c): the mean price of a day."""
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_shipdate").cast("date").alias("d")).agg(F.avg(F.try_divide("l_extendedprice", "l_quantity")).alias("c"))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity-attribute-value facts: entity, period_end (a week's first day), filed, concept, val."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("sym"), F.date_trunc("week", "ts").cast("date").alias("period_end"), F.col("ts").alias("filed"), F.col("event_type").alias("concept"), F.col("value").alias("val"), "event_id")


def watermark(bars: DataFrame) -> DataFrame:
    """The day up to which every symbol has bars: the least of the symbols' last days."""
    return bars.groupBy("sym").agg(F.max("d").alias("last")).agg(F.min("last").alias("watermark"), F.count("*").alias("symbols"))


def freshness(bars: DataFrame, start: str, last_session: str) -> DataFrame:
    """Per symbol whether its bars cover start .. last_session."""
    a = bars.groupBy("sym").agg(F.min("d").alias("first"), F.max("d").alias("last"))
    return a.withColumn("fresh", (F.col("first") <= F.lit(start).cast("date")) & (F.col("last") >= F.lit(last_session).cast("date")))


def newest_first(df: DataFrame, universe: DataFrame, most: int) -> DataFrame:
    """Symbols to refresh: never fetched first, then the stalest; ties by symbol."""
    seen = df.groupBy("sym").agg(F.max("d").alias("last"))
    return universe.join(seen, "sym", "left").orderBy(F.col("last").asc_nulls_first(), "sym").limit(most)
