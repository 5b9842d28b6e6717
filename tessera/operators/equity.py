"""The equity panel: 158 features, four factors and three excess labels of every symbol and day, standardised for training.

Features, factors and labels are windows over one frame, so bars take one exchange by symbol. The frame is written once
before its training statistics are fitted; these are one-row tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import windows as w
from tessera.operators import asof, events, factors, labels, normalize, panels, rolling
from tessera.sources.scratch import cut

FACTORS = ["mom_carry_12_1", "beta_dm", "rvar_total", "idio_vol_market"]
LABELS = [f"fwd_{n}d_excess" for n in labels.HORIZONS]
#: Fixed value: finite training values that a factor needs, one year of rows.
LEAST_HISTORY = 252


def raw(bars: DataFrame, market: DataFrame, with_factors: bool = True) -> DataFrame:
    """(sym, d, features, factors, labels) of bars (sym, d, o h l c v) against market (d, c). The market is matched as of a day, at
    most five days old for the labels and five rows for the factors."""
    x = asof.asof_join(bars, market.select("d", F.col("c").alias("m5")), None, days=5)
    if with_factors:
        x = factors.size_z(factors.with_market(x, market))
    x = rolling.prepared(x)
    ahead = lambda c, n: F.try_divide(w.lead(c, n), F.col(c)) - 1
    made = {"mom_carry_12_1": factors.momentum(), "beta_dm": factors.market_beta(), "rvar_total": factors.variance(), "idio_vol_market": factors.residual_deviation()} if with_factors else {}
    columns = rolling.shape() | {k: v for n in rolling.WINDOWS for k, v in rolling.family(n).items()} | made
    columns |= {f"fwd_{n}d_excess": ahead("c", n) - ahead("m5", n) for n in labels.HORIZONS}
    return x.select("sym", "d", *(v.alias(k) for k, v in columns.items()))


def panel(bars: DataFrame, market: DataFrame, splits: DataFrame, with_factors: bool = True, least: int = LEAST_HISTORY) -> DataFrame:
    """The panel with ``split``: splits (sym, d, split) by day, other days are test. The job fails where a factor has fewer than
    ``least`` finite training values. Rows without all labels go before anything is fitted; features and factors are clipped to the
    training rows' 0.001 and 0.999 quantiles, standardised by their clipped mean and deviation, null to 0, clipped to +-5; labels
    are standardised within each day."""
    names = [*rolling.feature_names(), *(FACTORS if with_factors else [])]
    x = panels.split_labels(cut(raw(bars, market, with_factors)), splits)
    if with_factors:
        short = panels.train_history(x, FACTORS, least).where("not enough").agg(F.concat_ws(", ", F.array_sort(F.collect_list("feature"))).alias("_short"))  # one row
        enough = F.when(F.col("_short") != "", F.raise_error(F.concat(F.lit("too short a training history: "), "_short")))
        x = x.join(F.broadcast(short), F.lit(True)).where(enough.cast("boolean").isNull()).drop("_short")
    x = panels.train_standardised(x.dropna(subset=LABELS), names)
    return x.select("sym", "d", *names, *(normalize.label_z(F.col(c)).alias(c) for c in LABELS), "split")


# ---- fundamentals, events and sentiment beside it

FUND = ["earnings_yield", "book_to_price", "gross_profitability", "roe", "asset_growth"]
DRIFT = ["days_since_earnings", "pead_signal", "pead_quintile_rank"]
SURPRISE = ["sue_signal", "surprise_momentum", "surprise_streak"]
#: Fixed value: days over which an announcement's effect decays.
DECAY_DAYS = 60


def _filled(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: normalize.median_fill(F.col(c).cast("double")) for c in columns})


def covered(panel_: DataFrame, feed: DataFrame, truncate: bool) -> DataFrame:
    """The panel, which must not run beyond the feed's last day: later rows go if ``truncate``, else the job fails."""
    last = F.broadcast(feed.agg(F.max("d").alias("_last")))  # one row
    x, late = panel_.join(last, F.lit(True)), F.col("d") > F.col("_last")
    if truncate:
        return x.where(~late).drop("_last")
    return x.where(F.when(late, F.raise_error(F.concat(F.lit("the panel runs beyond the fundamentals, which end on "), F.col("_last").cast("string")))).cast("boolean").isNull()).drop("_last")


def with_events(panel_: DataFrame, earn: DataFrame, window: int = DECAY_DAYS) -> DataFrame:
    """Adds drift after announcements and surprise features: those of the last event (sym, d, surprise) up to the day, decaying to 0
    over ``window`` days. After that, drift is unknown, but surprise features are 0. Unknown values take the day's median, then 0."""
    history = events.surprise_history(earn.groupBy("sym", "d").agg(F.max("surprise").alias("surprise")))
    keys = panel_.select("sym", "d")
    x = asof.asof_join(keys, history.select("*", F.col("d").alias("event_d")))
    age = F.datediff("d", "event_d")
    recent, decay = age <= window, F.greatest(F.lit(0.0), 1 - age / window)
    x = x.withColumns({"days_since_earnings": F.when(recent, age).cast("double"), "_s": F.when(recent, F.col("surprise"))})
    x = normalize.percent_rank_average(x.withColumn("pead_signal", F.col("_s") * decay), "_s", "pead_quintile_rank")
    late = F.coalesce(age > window, F.lit(True))
    faded = lambda c: F.when(~late, F.col(c) * decay).when(F.col("_known"), F.lit(0.0))
    listed = earn.select("sym").distinct().withColumn("_known", F.lit(True))  # a symbol without any event has no surprise features at all
    x = x.join(listed, "sym", "left").withColumn("_known", F.coalesce("_known", F.lit(False)))
    x = x.select("sym", "d", *DRIFT, faded("sue").alias("sue_signal"), faded("momentum").alias("surprise_momentum"), faded("streak").alias("surprise_streak"))
    return panels.attach(panel_, _filled(x, [*DRIFT, *SURPRISE]), ["sym", "d"])


def with_sentiment(panel_: DataFrame, sentiment: DataFrame, columns: list[str], since: str = "2020-01-01") -> DataFrame:
    """Adds sentiment (sym, d, n_articles, ...) from ``since`` on: log1p of the articles and the ``columns``, gaps by the day's median, then
    0. The job fails where a symbol and day occurs twice."""
    s = sentiment.where(F.col("d") >= F.lit(since).cast("date")).select("sym", "d", *columns, F.log1p(F.col("n_articles").cast("double")).alias("n_articles_log"))
    return _filled(panels.attach(panel_, s, ["sym", "d"]), [*columns, "n_articles_log"])


def fund_panel(panel_: DataFrame, feed: DataFrame, earn: DataFrame, sentiment: DataFrame, sentiment_columns: list[str], truncate: bool = False, since: str = "2020-01-01") -> DataFrame:
    """The equity panel with fundamentals, drift and surprise features and sentiment; its rows are those it had."""
    x = panels.attach(covered(panel_, feed, truncate), feed.select("sym", "d", *FUND), ["sym", "d"])
    return with_sentiment(with_events(_filled(x, FUND), earn), sentiment, sentiment_columns, since)
