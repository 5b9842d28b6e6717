"""Technical indicators. Exponential means are recursive: each symbol's history is one Arrow group (a century of days is
36,500 rows) that pandas goes through once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tessera.functions import windows as w


def ewm(df: DataFrame, **columns: tuple[str, float]) -> DataFrame:
    """Adds exponential means: out=(column, alpha). Nulls count as a position without a value: the weight of the past
    decays over them."""
    schema = StructType([*df.schema.fields, *(StructField(o, DoubleType()) for o in columns)])

    def smoothed(history):
        history = history.sort_values("d")
        return history.assign(**{o: history[c].astype(float).ewm(alpha=a, adjust=False).mean() for o, (c, a) in columns.items()})

    return df.groupBy("sym").applyInPandas(smoothed, schema)


def gate(x: Column, seen: Column, least: int) -> Column:
    return F.when(F.count(seen).over(w.so_far()) >= least, x)


def rsi(bars: DataFrame, n: int = 14) -> DataFrame:
    d = bars.select("sym", "d", "c").withColumn("dc", F.col("c") - w.lag("c"))
    d = d.withColumns({"g": w.at_least_zero(F.col("dc")), "b": w.at_least_zero(-F.col("dc"))})
    e = ewm(d, ag=("g", 1 / n), ab=("b", 1 / n))
    x = 100 - 100 / (1 + F.try_divide("ag", "ab"))  # null without losses
    return e.select("sym", "d", gate(x, F.col("dc"), n).alias("rsi"))


def macd_histogram(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    e = ewm(bars.select("sym", "d", "c"), f=("c", 2 / (fast + 1)), s=("c", 2 / (slow + 1)))
    e = ewm(e.select("sym", "d", (F.col("f") - F.col("s")).alias("macd")), sig=("macd", 2 / (signal + 1)))
    return e.select("sym", "d", (F.col("macd") - F.col("sig")).alias("macd_hist"))


def true_range() -> Column:
    """Without a previous close the day's own range: greatest() skips null."""
    h, l, p = F.col("h"), F.col("l"), w.lag("c")
    return F.greatest(h - l, F.abs(h - p), F.abs(l - p))


def atr(bars: DataFrame, n: int = 14) -> DataFrame:
    e = ewm(bars.select("sym", "d", true_range().alias("tr")), atr=("tr", 1 / n))
    return e.select("sym", "d", gate(F.col("atr"), F.col("tr"), n).alias("atr"))


def adx(bars: DataFrame, n: int = 14) -> DataFrame:
    up, down = F.col("h") - w.lag("h"), w.lag("l") - F.col("l")
    d = bars.withColumns({"tr": true_range(), "up": up, "down": down})
    d = d.select("sym", "d", "tr", F.when((F.col("up") > F.col("down")) & (F.col("up") > 0), F.col("up")).otherwise(0.0).alias("pdm"), F.when((F.col("down") > F.col("up")) & (F.col("down") > 0), F.col("down")).otherwise(0.0).alias("mdm"))
    e = ewm(d, a=("tr", 1 / n), p=("pdm", 1 / n), m=("mdm", 1 / n))
    a = gate(F.col("a"), F.col("tr"), n)
    e = e.withColumns({k: 100 * F.try_divide(gate(F.col(x), F.col(y), n), a) for k, x, y in (("pdi", "p", "pdm"), ("mdi", "m", "mdm"))})
    e = ewm(e.select("sym", "d", (100 * F.try_divide(F.abs(F.col("pdi") - F.col("mdi")), F.col("pdi") + F.col("mdi"))).alias("dx")), adx=("dx", 1 / n))
    return e.select("sym", "d", gate(F.col("adx"), F.col("dx"), n).alias("adx"))


def windowed(bars: DataFrame, n: int = 20) -> DataFrame:
    """CCI, half-z Bollinger position, Williams %R, lag-one autocorrelation of returns (0 where they are
    constant): windows alone."""
    tp = (F.col("h") + F.col("l") + F.col("c")) / 3
    x = bars.withColumns({"tp": tp, "r": F.try_divide("c", w.lag("c")) - 1})
    x = x.withColumns({"tps": w.rolled(F.col("tp"), n, F.collect_list), "tpm": w.mean(F.col("tp"), n), "r1": w.lag("r")})
    mad = F.aggregate("tps", F.lit(0.0), lambda a, v: a + F.abs(v - F.col("tpm"))) / n
    high, low = w.rolled(F.col("h"), 14, F.max), w.rolled(F.col("l"), 14, F.min)
    return x.select(
        "sym",
        "d",
        F.try_divide(F.col("tp") - F.col("tpm"), 0.015 * mad).alias("cci"),
        F.try_divide(F.col("c") - w.mean(F.col("c"), n), 2 * w.deviation(F.col("c"), n)).alias("bbp"),
        (-100 * F.try_divide(high - F.col("c"), high - low)).alias("williams_r"),
        F.when(F.count(F.when(F.col("r1").isNotNull(), F.col("r"))).over(w.last_rows(n - 1)) == n - 1, F.coalesce(w.correlation(F.col("r"), F.col("r1"), n - 1), F.lit(0.0))).alias("autocorr"),
    )


def obv_slope(bars: DataFrame) -> DataFrame:
    """Change over five rows of the smoothed on-balance volume, relative to its value, sign included, five rows ago."""
    signed = F.coalesce(F.signum(F.col("c") - w.lag("c")), F.lit(0.0)) * F.col("v")
    x = bars.select("sym", "d", signed.alias("sv")).withColumn("obv", F.sum("sv").over(w.so_far()))
    e = ewm(x, e=("obv", 2 / 21))
    return e.select("sym", "d", F.try_divide(F.col("e") - w.lag("e", 5), w.lag("e", 5)).alias("obv_slope"))


def sma_latest(bars: DataFrame, n: int = 50, least: int = 60) -> DataFrame:
    """Per symbol its last n-row mean, where it has ``least`` bars and the mean is positive."""
    x = bars.select("sym", "d", w.mean(F.col("c"), n).alias("sma"), F.count("*").over(w.so_far()).alias("k"))
    last = x.groupBy("sym").agg(F.max(F.struct("d", "sma", "k")).alias("x")).select("sym", "x.*")
    return last.where((F.col("k") >= least) & (F.col("sma") > 0)).select("sym", "d", F.round("sma", 8).alias("sma"))
