"""Indicators of every symbol against those of a benchmark, with the benchmark's own state.

All seven indicators come from one frame: windows for what is a window, and two turns of exponential means (the second for the
means of means), so bars are read and sorted once and nothing is joined to itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import windows as w
from tessera.operators.technical import ewm, gate, true_range

INDICATORS = ["rsi", "macd_hist", "cci", "bbp", "adx", "williams_r", "obv_slope"]
RATIOS = ["rsi", "adx"]
CONTEXT = ["spy_realized_vol", "spy_adx", "spy_trend", "hurst"]


def indicators(bars: DataFrame, n: int = 14, fast: int = 12, slow: int = 26, signal: int = 9, period: int = 20, obv: int = 20, more: dict[str, tuple[str, float]] | None = None) -> DataFrame:
    """bars (sym, d, o h l c v) with the seven indicators; null where one's window is not full. ``more``: further exponential
    means of the first turn."""
    up, down, move = F.col("h") - w.lag("h"), w.lag("l") - F.col("l"), F.col("c") - w.lag("c")
    tp = (F.col("h") + F.col("l") + F.col("c")) / 3
    x = bars.withColumns({"_dc": move, "_up": up, "_down": down, "_tr": true_range(), "_tp": tp})
    one_way = lambda a, b: F.when((F.col(a) > F.col(b)) & (F.col(a) > 0), F.col(a)).otherwise(0.0)
    x = x.withColumns({"_gain": w.at_least_zero(F.col("_dc")), "_loss": w.at_least_zero(-F.col("_dc")), "_plus": one_way("_up", "_down"), "_minus": one_way("_down", "_up")})
    high, low = w.rolled(F.col("h"), n, F.max), w.rolled(F.col("l"), n, F.min)
    x = x.withColumns({
        "_obv": F.sum(F.coalesce(F.signum("_dc"), F.lit(0.0)) * F.col("v")).over(w.so_far()), "_tpm": w.mean(F.col("_tp"), period), "_tps": w.rolled(F.col("_tp"), period, F.collect_list),
        "bbp": F.try_divide(F.col("c") - w.mean(F.col("c"), period), 2 * w.deviation(F.col("c"), period)), "williams_r": -100 * F.try_divide(high - F.col("c"), high - low),
        "_seen": F.count("_dc").over(w.so_far()), "_rows": F.count("*").over(w.so_far()),
    })
    spread = F.aggregate("_tps", F.lit(0.0), lambda a, v: a + F.abs(v - F.col("_tpm"))) / period
    x = x.withColumn("cci", F.try_divide(F.col("_tp") - F.col("_tpm"), 0.015 * spread)).drop("_tps")
    means = {"_g": ("_gain", 1 / n), "_b": ("_loss", 1 / n), "_a": ("_tr", 1 / n), "_p": ("_plus", 1 / n), "_m": ("_minus", 1 / n), "_f": ("c", 2 / (fast + 1)), "_s": ("c", 2 / (slow + 1)), "_o": ("_obv", 2 / (obv + 1))}
    x = ewm(x, **means, **(more or {}))
    full = F.col("_rows") >= n
    side = lambda c: 100 * F.try_divide(F.when(full, F.col(c)), F.when(full, F.col("_a")))
    x = x.withColumns({"_macd": F.col("_f") - F.col("_s"), "_dx": 100 * F.try_divide(F.abs(side("_p") - side("_m")), side("_p") + side("_m"))})
    x = ewm(x, _sig=("_macd", 2 / (signal + 1)), _adx=("_dx", 1 / n))
    out = {
        "rsi": F.when(F.col("_seen") >= n, 100 - 100 / (1 + F.try_divide("_g", "_b"))), "macd_hist": F.col("_macd") - F.col("_sig"), "cci": F.col("cci"), "bbp": F.col("bbp"),
        "adx": gate(F.col("_adx"), F.col("_dx"), n), "williams_r": F.col("williams_r"), "obv_slope": F.try_divide(F.col("_o") - w.lag("_o", 5), w.lag("_o", 5)),
    }
    return x.select(*bars.columns, *(out[c].alias(c) for c in INDICATORS), *(more or {}))


def rescaled_range(returns: Column, size: int) -> Column:
    """Mean over an array's consecutive chunks of ``size`` of the range of the summed deviations over their deviation."""

    def one(x: Column) -> Column:
        mean = F.aggregate(x, F.lit(0.0), lambda s, v: s + v) / size
        start = F.struct(F.lit(0.0).alias("s"), F.lit(-math.inf).alias("hi"), F.lit(math.inf).alias("lo"), F.lit(0.0).alias("q"))

        def step(a: Column, v: Column) -> Column:
            s = a["s"] + v - mean
            return F.struct(s.alias("s"), F.greatest(a["hi"], s).alias("hi"), F.least(a["lo"], s).alias("lo"), (a["q"] + (v - mean) * (v - mean)).alias("q"))

        return F.aggregate(x, start, step, lambda a: F.when(a["q"] > 0, (a["hi"] - a["lo"]) / F.sqrt(a["q"] / size)))

    chunks = F.transform(F.sequence(F.lit(0), F.floor(F.size(returns) / size).cast("int") - 1), lambda i: one(F.slice(returns, i * size + 1, size)))
    known = F.filter(chunks, lambda x: x.isNotNull())
    return F.try_divide(F.aggregate(known, F.lit(0.0), lambda s, v: s + v), F.size(known))


def hurst(r: Column) -> Column:
    """Rolling Hurst exponent of 63 returns: the slope of the log of the rescaled range over the log of chunks of 7, 21 and 63.
    These logs are evenly spaced, so least squares give the middle one no weight. Null before 63 returns."""
    last = w.rolled(r, 63, F.collect_list)
    y = lambda n: F.ln(F.nullif(rescaled_range(last, n), F.lit(0.0)))
    return F.when(last.isNotNull(), (y(63) - y(7)) / (2 * math.log(3)))


def context(benchmark: DataFrame, vol: int = 20) -> DataFrame:
    """The benchmark (one symbol) by day, each value from bars up to that day: its indicators (null where not all are known), close,
    yearly volatility of ``vol`` returns (0 before), trend strength (25 before), close over its mean of 50 (1 where that is 0) and
    Hurst exponent (0 before)."""
    x = indicators(benchmark, more={"_e50": ("c", 2 / 51)}).withColumn("_r", F.try_divide("c", w.lag("c")) - 1)
    known = F.lit(True)
    for c in INDICATORS:
        known = known & F.col(c).isNotNull()
    return x.select(
        "d", F.when(known, F.col("c")).alias("m_c"), *(F.when(known, F.col(c)).alias(f"m_{c}") for c in INDICATORS), F.coalesce(w.deviation(F.col("_r"), vol) * math.sqrt(252), F.lit(0.0)).alias("spy_realized_vol"),
        F.coalesce("adx", F.lit(25.0)).alias("spy_adx"), F.coalesce(F.try_divide("c", "_e50"), F.lit(1.0)).alias("spy_trend"), F.coalesce(hurst(F.col("_r")), F.lit(0.0)).alias("hurst"),
    )


def frame(bars: DataFrame, benchmark: DataFrame, least: int = 10) -> DataFrame:
    """Each symbol's close and features on days that it shares with the benchmark, where all of both's indicators are known (symbols with
    ``least`` such days): RSI and ADX over the benchmark's, the others less the benchmark's; close over its own means of 50 and 200 and
    the change of close over the benchmark's close, all counted in shared days; the benchmark's state. Rows with a null go."""
    x = indicators(bars).dropna(subset=INDICATORS).join(F.broadcast(context(benchmark).where("m_c is not null")), "d")  # a row for each day
    x = x.withColumn("_n", F.count("*").over(Window.partitionBy("sym"))).where(F.col("_n") >= least)
    x = ewm(x.select("sym", "d", "c", *INDICATORS, "m_c", *(f"m_{k}" for k in INDICATORS), *CONTEXT), _e50=("c", 2 / 51), _e200=("c", 2 / 201)).withColumn("_rel", F.try_divide("c", "m_c"))
    against = [(F.try_divide(c, f"m_{c}") if c in RATIOS else F.col(c) - F.col(f"m_{c}")).alias(c) for c in INDICATORS]
    gain = lambda n: (F.try_divide("_rel", w.lag("_rel", n)) - 1).alias(f"rel_mom_{n}d")
    return x.select("sym", "d", F.col("c").alias("close"), *against, F.try_divide("c", "_e50").alias("trend"), F.try_divide("c", "_e200").alias("trend_long"), gain(20), gain(60), *CONTEXT).dropna()
