"""Registered queries, tenth part: the training corpus, the table of raw labels, and macro frames with their coverage gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import corpus, equity, labels, macro, panels, rolling
from tessera.plans import sql
from tessera.plans.more_queries import _rz
from tessera.plans.queries import ORACLES, query, rounded
from tessera.sources import tables as t

# ---- a panel of bar shapes and excess labels under a contract, and a list of some brands
_shape = rolling.feature_names()[:13]  # the bar shapes, which no window makes
COLUMNS = corpus.contract(_shape, family=[])
_labels = ", ".join(equity.LABELS)
PANEL = f"""shape AS ({ORACLES['kbar_price']}), lab AS ({ORACLES['fwd_excess_asof']}),
pan AS (SELECT upper(sym) AS sym, d, {', '.join(_shape)}, {_labels}, CASE WHEN year(d) < 1997 THEN 'train' ELSE 'test' END AS split FROM shape JOIN lab USING (sym, d)),
watch AS (SELECT DISTINCT upper(p_brand) AS sym FROM part WHERE p_brand LIKE '%1' OR p_brand IN ('Brand#7', 'Brand#22') UNION SELECT 'NEVER')"""
_whole = " AND ".join(f"{c} IS NOT NULL" for c in equity.LABELS)
RAW = f"raw AS ({ORACLES['fwd_excess_exact']})"
#: A panel that ends for some symbols earlier, so days of bars are left beyond it.
SHORT = "sp AS (SELECT * FROM pan WHERE d <= DATE '2001-03-31' OR sym LIKE '%2')"


def _panel(spark, d):
    bars = t.bars_daily(spark, d)
    x = bars.select("sym", "d", *(v.alias(k) for k, v in rolling.shape().items()))
    x = panels.split_labels(x, bars.where(F.year("d") < 1997).select("sym", "d", F.lit("train").alias("split")))
    return x.join(labels.excess_asof(bars, t.market_daily(spark, d)), ["sym", "d"]).select("sym", "d", *_shape, *equity.LABELS, "split")


def _watch(spark, d):
    p = t.table(spark, d, "part").where("p_brand like '%1' or p_brand in ('Brand#7', 'Brand#22')")
    return p.select(F.lower("p_brand").alias("sym")).union(spark.range(1).select(F.lit("never")))


def _short(spark, d):
    return _panel(spark, d).where("d <= date'2001-03-31' or sym like '%2'")


@query(f"WITH {PANEL} SELECT sym, d, {', '.join(_shape)}, {_labels}, split FROM pan WHERE sym IN (SELECT sym FROM watch) AND {_whole}")
def training_corpus(spark, d):
    return rounded(corpus.training_corpus(_panel(spark, d), _watch(spark, d), COLUMNS))


@query(f"""WITH {PANEL} SELECT count(*) FILTER ({_whole}) AS n_rows, count(DISTINCT sym) FILTER ({_whole}) AS n_symbols, {len(COLUMNS)} AS n_columns, min(d) FILTER ({_whole}) AS first, max(d) FILTER ({_whole}) AS last,
  count(*) FILTER (NOT ({_whole})) AS n_dropped, (SELECT string_agg(sym, ',' ORDER BY sym) FROM watch WHERE sym NOT IN (SELECT sym FROM pan)) AS absent FROM pan WHERE sym IN (SELECT sym FROM watch)""")
def training_corpus_report(spark, d):
    return corpus.corpus_report(_panel(spark, d), _watch(spark, d), COLUMNS)


EXTENDED = f"""{PANEL}, {SHORT}, {RAW}, ends AS (SELECT sym, max(d) AS z FROM sp GROUP BY sym),
ext AS (SELECT * FROM sp UNION ALL BY NAME SELECT upper(raw.sym) AS sym, raw.d FROM raw JOIN ends ON ends.sym = upper(raw.sym) AND raw.d > z),
tab AS (SELECT ext.*, fwd_60d_excess_raw FROM ext LEFT JOIN raw ON upper(raw.sym) = ext.sym AND raw.d = ext.d AND raw.sym NOT LIKE '%13')"""


def _raw(spark, d, extend):
    bars = t.bars_daily(spark, d)
    return corpus.raw_label_table(_short(spark, d), bars, t.market_daily(spark, d), F.lit("2003-01-01").cast("date"), COLUMNS, extend=extend)


@query(f"WITH {PANEL}, {SHORT}, {RAW} SELECT sp.*, fwd_60d_excess_raw FROM sp LEFT JOIN raw ON upper(raw.sym) = sp.sym AND raw.d = sp.d")
def raw_labels(spark, d):
    """The panel as it is, with raw labels."""
    return rounded(_raw(spark, d, False))


@query(f"WITH {EXTENDED.replace(chr(32) + 'AND raw.sym NOT LIKE ' + repr('%13'), '')} SELECT * FROM tab")
def raw_labels_extended(spark, d):
    """Also the days of bars beyond each symbol's panel."""
    return rounded(_raw(spark, d, True))


@query(f"""WITH {EXTENDED} SELECT count(*) FILTER (sym NOT LIKE '%13' OR d <= z) AS n_rows, (SELECT count(*) FROM sp) AS n_panel, count(*) FILTER (sym NOT LIKE '%13' OR d <= z) - (SELECT count(*) FROM sp) AS n_extended, count(DISTINCT sym) AS n_symbols,
  min(d) AS first, max(d) FILTER (sym NOT LIKE '%13' OR d <= z) AS last, max(d) FILTER (fwd_60d_excess_raw IS NOT NULL) AS last_labelled, count(fwd_60d_excess_raw) AS n_labelled,
  count(*) FILTER (sym NOT LIKE '%13' OR d <= z) - count(fwd_60d_excess_raw) AS n_unlabelled, 'BRAND#13' AS unpriced FROM tab JOIN ends USING (sym)""")
def raw_labels_report(spark, d):
    """One brand has no bars: its rows stay without a label, and no day is added for it."""
    bars, p = t.bars_daily(spark, d).where("sym not like '%13'"), _short(spark, d)
    x = corpus.raw_label_table(p, bars, t.market_daily(spark, d), F.lit("2003-01-01").cast("date"), COLUMNS, extend=True)
    return corpus.raw_label_report(x, p, bars)


# ---- macro frames: brands as series, of which those that end in 5 begin late
UNTIL, WINDOW = "1996-12-31", 60
SYMBOLS = [f"Brand#{k}" for k in range(1, 26)]
LAGS = {s: 5 if s.endswith("2") else 0 if s.endswith("4") else 3 for s in SYMBOLS}
_cols = ", ".join(f"round({k}, 6) + 0.0 AS {k}" for k in macro.TRANSFORMS)
_z = ", ".join(f"{_rz(c)} AS {k}" for k, c in zip(macro.TRANSFORMS, ("c", "x5", "x20")))
_roll = "WINDOW w AS (PARTITION BY sym ORDER BY d ROWS 59 PRECEDING)"
_wanted = "want AS (SELECT 'Brand#' || k AS sym FROM range(1, 26) x(k) UNION ALL SELECT 'Nothing')"
_verdict = "ver AS (SELECT want.sym, share, CASE WHEN n IS NULL OR n = 0 THEN 'no_rows' WHEN share < 0.95 THEN 'coverage' END AS reason FROM want LEFT JOIN (SELECT sym, count(c) AS n, avg(judged::INT) AS share FROM sc GROUP BY sym) USING (sym))"
MARKETS = f"""{sql.BARS}, {_wanted}, s AS (SELECT sym, d, c FROM bars WHERE sym NOT LIKE '%5' OR d >= DATE '1996-11-15'),
ch AS (SELECT *, c / lag(c, 5) OVER k - 1 AS x5, c / lag(c, 20) OVER k - 1 AS x20 FROM s WINDOW k AS (PARTITION BY sym ORDER BY d)), z AS (SELECT sym, d, c, {_z} FROM ch {_roll}),
sc AS (SELECT *, CASE WHEN d BETWEEN DATE '{UNTIL}' - {2 * WINDOW} AND DATE '{UNTIL}' THEN level_z IS NOT NULL END AS judged FROM z), {_verdict}"""
RATES = f"""{sql.BARS}, {_wanted}, cal AS (SELECT DISTINCT d FROM bars), days AS (SELECT sym, d FROM want, cal WHERE sym <> 'Nothing'), rel AS (SELECT sym, d, c FROM bars WHERE day(d) <= 7 AND (sym NOT LIKE '%5' OR d >= DATE '1997-09-01')),
j AS (SELECT days.sym, days.d, rel.c FROM days ASOF LEFT JOIN rel ON rel.sym = days.sym AND days.d >= rel.d),
s AS (SELECT sym, d, CASE WHEN sym LIKE '%2' THEN lag(c, 5) OVER k WHEN sym LIKE '%4' THEN c ELSE lag(c, 3) OVER k END AS c FROM j WINDOW k AS (PARTITION BY sym ORDER BY d)),
ch AS (SELECT *, c - lag(c, 5) OVER k AS x5, c - lag(c, 20) OVER k AS x20, row_number() OVER k AS pos FROM s WINDOW k AS (PARTITION BY sym ORDER BY d)), z AS (SELECT sym, d, c, pos, {_z} FROM ch {_roll}),
near AS (SELECT pos FROM z WHERE sym = 'Brand#1' ORDER BY abs(date_diff('day', d, DATE '{UNTIL}')), d DESC LIMIT 1),
sc AS (SELECT *, CASE WHEN pos >= (SELECT pos FROM near) - {2 * WINDOW} THEN c IS NOT NULL END AS judged FROM z), {_verdict}"""


def _late(df, since):
    return df.where(f"sym not like '%5' or d >= date'{since}'")


def _markets(spark, d):
    return macro.market_scores(_late(t.bars_daily(spark, d), "1996-11-15"), F.lit(UNTIL).cast("date"), WINDOW)


def _rates(spark, d):
    bars = t.bars_daily(spark, d)
    releases = _late(bars.where(F.dayofmonth("d") <= 7).select("sym", "d", "c"), "1997-09-01")
    return macro.rate_scores(releases, bars, LAGS, F.lit(UNTIL).cast("date"), WINDOW)


def _judged(spark, scores):
    return macro.verdicts(scores, spark.createDataFrame([(s,) for s in [*SYMBOLS, "Nothing"]], "sym string"))


for _name, _sql, _made, _relative in (("macro", MARKETS, _markets, True), ("rates", RATES, _rates, False)):
    _used = "z.sym IN (SELECT sym FROM ver WHERE reason IS NULL)"

    @query(f"WITH {_sql} SELECT sym, d, {_cols} FROM z WHERE {_used}", name=f"{_name}_frame")
    def _frame(spark, d, made=_made):
        x = made(spark, d)
        return rounded(macro.frame(x, _judged(spark, x)))

    @query(f"WITH {_sql} SELECT sym, reason IS NULL AS used, round(share, 6) AS share, reason FROM ver", name=f"{_name}_verdicts")
    def _verdicts(spark, d, made=_made):
        return rounded(_judged(spark, made(spark, d)))


@query(f"WITH {RATES} SELECT sym, d, round(chg, 6) + 0.0 AS chg FROM (SELECT sym, d, level_z - lag(level_z) OVER (PARTITION BY sym ORDER BY d) AS chg FROM z WHERE sym IN (SELECT sym FROM ver WHERE reason IS NULL)) WHERE chg IS NOT NULL")
def rates_changes(spark, d):
    x = _rates(spark, d)
    return rounded(macro.changes(macro.frame(x, _judged(spark, x)), False))


@query(f"WITH {MARKETS} SELECT d, {', '.join(f'''round(max(CASE WHEN sym = '{s}' THEN {k} END), 6) + 0.0 AS "{s.lower()}_{k}"''' for s in SYMBOLS[3:7] for k in macro.TRANSFORMS)} FROM z WHERE sym IN (SELECT sym FROM ver WHERE reason IS NULL) GROUP BY d")
def macro_wide(spark, d):
    x = _markets(spark, d)
    return rounded(macro.wide(macro.frame(x, _judged(spark, x)), SYMBOLS[3:7]))
