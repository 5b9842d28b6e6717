"""The training corpus and the table of raw labels, both drawn from the fund panel under a contract of columns.

Contracts are checked against the schema when the plan is made; what only rows can tell (repeated keys, days to come) stops the
job, and each table's one-row report stops it where the table is empty. Run the report before a table is published.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import equity, labels, panels, rolling

#: The contract's last three columns.
SENTIMENT = ["sentiment_pos_share", "mean_sentiment", "n_articles_log"]
RAW_LABEL = "fwd_60d_excess_raw"


def contract(features: Sequence[str] | None = None, family: Sequence[str] = (*equity.FUND, *equity.DRIFT, *equity.SURPRISE, *SENTIMENT)) -> list[str]:
    """The 178 columns in their order: key, 158 features (``features`` instead, if given), labels, split, fund family."""
    return ["sym", "d", *(rolling.feature_names() if features is None else features), *equity.LABELS, "split", *family]


def contracted(panel: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """The panel in the contract's columns, order and types, symbols in upper case. A missing column is an error, and so is one
    too many unless not ``exact``; a repeated (sym, d) stops the job."""
    missing, extra = [c for c in columns if c not in panel.columns], [c for c in panel.columns if c not in columns]
    if missing:
        raise ValueError(f"columns of the contract are missing: {', '.join(missing[:8])}")
    if extra and exact:
        raise ValueError(f"columns beyond the contract: {', '.join(extra[:8])}")
    typed = {"sym": F.upper("sym"), "d": F.col("d").cast("date"), "split": F.col("split").cast("string")}
    return panels.single(panel.select(*(typed.get(c, F.col(c).cast("double")).alias(c) for c in columns)), ["sym", "d"])


def _listed(watchlist: DataFrame) -> DataFrame:
    return watchlist.select(F.upper("sym").alias("sym")).distinct()


def training_corpus(panel: DataFrame, watchlist: DataFrame, columns: Sequence[str], needed: Sequence[str] = equity.LABELS, exact: bool = True) -> DataFrame:
    """Rows of listed symbols (sym) that have all ``needed`` labels, under the contract."""
    other = [c for c in needed if c not in columns]
    if other:
        raise ValueError(f"labels beyond the contract: {', '.join(other)}")
    x = contracted(panel, columns, exact).join(_listed(watchlist), "sym", "left_semi")
    return x.dropna(subset=list(needed)).select(*columns)


def _stop(when: Column, why: str, value: Column) -> Column:
    return F.when(when, F.raise_error(F.lit(why)).cast("long")).otherwise(value)


def corpus_report(panel: DataFrame, watchlist: DataFrame, columns: Sequence[str], needed: Sequence[str] = equity.LABELS) -> DataFrame:
    """One row: rows, symbols and days of the corpus, rows dropped for want of a label, listed symbols that the panel lacks. The
    job fails for an empty list, a panel with none of its symbols, and a corpus without a row."""
    whole = F.lit(True)
    for c in needed:
        whole = whole & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    per = panel.groupBy(F.upper("sym").alias("sym")).agg(F.count("*").alias("n"), F.count_if(whole).alias("kept"), *(f(F.when(whole, F.col("d"))).alias(k) for k, f in (("a", F.min), ("z", F.max))))
    x = _listed(watchlist).join(per, "sym", "left")
    one = x.agg(
        F.count("*").alias("listed"), F.count("n").alias("present"), F.sum("kept").alias("n_rows"), F.count_if(F.col("kept") > 0).alias("n_symbols"), F.min("a").alias("first"), F.max("z").alias("last"),
        F.sum(F.col("n") - F.col("kept")).alias("n_dropped"), F.concat_ws(",", F.array_sort(F.collect_list(F.when(F.col("n").isNull(), F.col("sym"))))).alias("absent"),  # a list of names
    )
    rows = _stop(F.col("listed") == 0, "the watch list is empty", _stop(F.col("present") == 0, "the panel has no listed symbol", _stop(F.col("n_rows") == 0, "no listed row has its labels", F.col("n_rows"))))
    return one.select(rows.alias("n_rows"), "n_symbols", F.lit(len(columns)).alias("n_columns"), "first", "last", "n_dropped", "absent")


def _known(df: DataFrame, today: Column, what: str) -> DataFrame:
    """``df``; a row after ``today`` stops the job."""
    late = F.when(F.col("d") > today, F.raise_error(F.concat(F.lit(f"{what} after today: "), F.col("d").cast("string"))))
    return df.where(late.cast("boolean").isNull())


def raw_label_table(panel: DataFrame, bars: DataFrame, market: DataFrame, today: Column, columns: Sequence[str], rows: int = 60, extend: bool = False, exact: bool = True) -> DataFrame:
    """All rows of the panel, labelled or not, with the return over ``rows`` rows of the symbol's bars (sym, d, c) less the
    market's (d, c) over as many of its own, from the same day; null where either is not known. ``extend`` adds the days of bars
    after a symbol's last row of the panel, without features. Nothing may lie after ``today``; bars have one row a day."""
    if RAW_LABEL in panel.columns:
        raise ValueError(f"the panel has a column {RAW_LABEL} already")
    if rows <= 0:
        raise ValueError("rows must be positive")
    x = contracted(_known(panel, today, "panel"), columns, exact)
    prices = panels.single(_known(bars.select(F.upper("sym").alias("sym"), F.col("d").cast("date").alias("d"), "c"), today, "bars"), ["sym", "d"])
    index = panels.single(_known(market.select(F.col("d").cast("date").alias("d"), "c"), today, "market"), ["d"])
    if extend:
        last = x.groupBy("sym").agg(F.max("d").alias("_last"))
        x = x.unionByName(prices.join(last, "sym").where("d > _last").select("sym", "d"), allowMissingColumns=True)
    raw = labels.excess_exact(prices, index, rows).withColumnRenamed(f"fwd_{rows}d_excess_raw", RAW_LABEL)
    return x.join(raw, ["sym", "d"], "left").select(*columns, RAW_LABEL)


def raw_label_report(table: DataFrame, panel: DataFrame, bars: DataFrame) -> DataFrame:
    """One row about a table of raw labels; the job fails where no row has one."""
    known = F.col(RAW_LABEL).isNotNull()
    one = table.agg(F.count("*").alias("n_rows"), F.countDistinct("sym").alias("n_symbols"), F.min("d").alias("first"), F.max("d").alias("last"), F.max(F.when(known, F.col("d"))).alias("last_labelled"), F.count_if(known).alias("n_labelled"))
    unpriced = panel.select(F.upper("sym").alias("sym")).distinct().join(bars.select(F.upper("sym").alias("sym")), "sym", "left_anti")
    n = panel.agg(F.count("*").alias("n_panel")).join(unpriced.agg(F.concat_ws(",", F.array_sort(F.collect_list("sym"))).alias("unpriced")), F.lit(True))  # one row each
    labelled = _stop(F.col("n_labelled") == 0, "no row has a raw label", F.col("n_labelled"))
    return one.join(F.broadcast(n), F.lit(True)).select("n_rows", "n_panel", (F.col("n_rows") - F.col("n_panel")).alias("n_extended"), "n_symbols", "first", "last", "last_labelled", labelled.alias("n_labelled"), (F.col("n_rows") - F.col("n_labelled")).alias("n_unlabelled"), "unpriced")
