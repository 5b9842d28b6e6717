"""Registered queries, ninth part: the whole equity panel, and the panel with fundamentals, events and sentiment."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import equity, factors, rolling
from tessera.plans import feed_queries, sql
from tessera.plans.queries import ALL_158, SHAPED, query, rounded
from tessera.sources import tables as t

_names = [*rolling.feature_names(), *equity.FACTORS]
_each = lambda text: ", ".join(text.replace("{c}", c) for c in _names)
_pair = "CASE WHEN rm IS NOT NULL THEN r END"
_both = "r IS NOT NULL AND rm IS NOT NULL"
_cov = lambda a, b: f"covar_samp(CASE WHEN {_both} THEN {a} END, CASE WHEN {_both} THEN {b} END) OVER w60"
#: Residual deviation of r on 1, rm and z from the moments of 60 rows.
_IDIO = f"""idio AS (SELECT sym, d, CASE WHEN n >= 10 AND k = 60 THEN sqrt(greatest(syy - CASE WHEN saa * sbb - sab * sab > 1e-18 * (saa * sbb + 1e-300) THEN (say * say * sbb - 2 * say * sby * sab + sby * sby * saa) / (saa * sbb - sab * sab) ELSE coalesce(say * say / nullif(saa, 0), 0) END, 0)) END AS idio_vol_market
  FROM (SELECT sym, d, count({_pair}) OVER w60 AS n, count(*) OVER w60 AS k, {_cov('rm', 'rm')} AS saa, {_cov('z', 'z')} AS sbb, {_cov('rm', 'z')} AS sab, {_cov('rm', 'r')} AS say, {_cov('z', 'r')} AS sby, {_cov('r', 'r')} AS syy FROM fz WINDOW w60 AS (PARTITION BY sym ORDER BY d ROWS 59 PRECEDING)))"""
FACTORS = f"""fx AS (SELECT sym, b.d, b.c, b.v, m.c AS m, m.d AS md FROM bars b ASOF LEFT JOIN mkt m ON b.d >= m.d), fl AS (SELECT * EXCLUDE (m), CASE WHEN row_number() OVER (PARTITION BY sym, md ORDER BY d) - max(CASE WHEN md = d THEN 1 ELSE 0 END) OVER (PARTITION BY sym, md) <= 5 THEN m END AS m, CASE WHEN date_diff('day', md, d) <= 5 THEN m END AS m5 FROM fx),
fy AS (SELECT *, c / lag(c) OVER s - 1 AS r, last_value(m IGNORE NULLS) OVER s / nullif(lag(m IGNORE NULLS) OVER s, 0) - 1 AS rm, ln(v * c + 1) AS sz FROM fl WINDOW s AS (PARTITION BY sym ORDER BY d)),
fz AS (SELECT *, coalesce(CASE WHEN count(sz) OVER w60 = 60 THEN (sz - avg(sz) OVER w60) / nullif(stddev_samp(sz) OVER w60, 0) END, 0) AS z FROM fy WINDOW w60 AS (PARTITION BY sym ORDER BY d ROWS 59 PRECEDING)), {_IDIO},
fac AS (SELECT sym, d, lag(c, 21) OVER s / nullif(lag(c, 252) OVER s, 0) - 1 AS mom_carry_12_1, CASE WHEN count({_pair}) OVER w252 >= 252 THEN covar_samp(r, rm) OVER w252 / nullif(var_samp(CASE WHEN r IS NOT NULL THEN rm END) OVER w252, 0) END AS beta_dm, CASE WHEN count(r) OVER w60 >= 60 THEN sum(r * r) OVER w60 END AS rvar_total,
  {', '.join(f'(lead(c, {n}) OVER s / c - 1) - (lead(m5, {n}) OVER s / nullif(m5, 0) - 1) AS fwd_{n}d_excess' for n in (5, 20, 60))} FROM fz WINDOW s AS (PARTITION BY sym ORDER BY d), w60 AS (PARTITION BY sym ORDER BY d ROWS 59 PRECEDING), w252 AS (PARTITION BY sym ORDER BY d ROWS 251 PRECEDING))"""
EQUITY = f"""WITH {sql.BARS}, {sql.MARKET}, {sql.PREPARED}, {SHAPED}, {FACTORS},
f158 AS (SELECT sym, d, {', '.join(f'{x} AS {k}' for x, k in ALL_158)} FROM qs {sql.windows(rolling.WINDOWS)}),
pnl AS (SELECT f158.*, fac.* EXCLUDE (sym, d), idio_vol_market, CASE WHEN year(f158.d) < 1999 THEN 'train' WHEN year(f158.d) < 2000 THEN 'valid' ELSE 'test' END AS split FROM f158 JOIN fac ON fac.sym = f158.sym AND fac.d = f158.d JOIN idio ON idio.sym = f158.sym AND idio.d = f158.d WHERE {' AND '.join(f'{c} IS NOT NULL' for c in equity.LABELS)}),
bnd AS (SELECT {_each('quantile_cont({c}, 0.001) AS lo_{c}, quantile_cont({c}, 0.999) AS hi_{c}')} FROM pnl WHERE split = 'train'),
k AS (SELECT sym, d, split, {', '.join(equity.LABELS)}, {_each('CASE WHEN hi_{c} > lo_{c} AND {c} IS NOT NULL THEN least(greatest({c}, lo_{c}), hi_{c}) ELSE {c} END AS {c}')} FROM pnl, bnd),
st AS (SELECT {_each('avg({c}) AS mean_{c}, stddev_samp({c}) AS sd_{c}')} FROM k WHERE split = 'train')
SELECT sym, d, split, {_each('round(least(greatest(coalesce(({c} - mean_{c}) / CASE WHEN sd_{c} > 1e-9 THEN sd_{c} ELSE 1 END, 0), -5), 5) + 1e-7, 4) + 0.0 AS {c}')},
  {', '.join(f'round(({c} - avg({c}) OVER x) / (stddev_samp({c}) OVER x + 1e-12) + 1e-7, 4) + 0.0 AS {c}' for c in equity.LABELS)} FROM k, st WINDOW x AS (PARTITION BY d)"""


@query(EQUITY)
def equity_alpha_panel(spark, d):
    """The whole panel: 158 features and four factors standardised on the days before 1999, three excess labels by day."""
    bars = t.bars_daily(spark, d)
    splits = bars.where(F.year("d") < 2000).select("sym", "d", F.when(F.year("d") < 1999, "train").otherwise("valid").alias("split"))
    x = equity.panel(bars, t.market_daily(spark, d), splits)
    return x.withColumns({c: F.round(F.col(c) + 1e-7, 4) + 0.0 for c in [*_names, *equity.LABELS]})


@query(f"WITH {sql.BARS}, {sql.MARKET}, {FACTORS} SELECT sym, d, round(idio_vol_market + 1e-9, 6) AS idio_vol FROM idio")
def residual_volatility(spark, d):
    x = factors.size_z(factors.with_market(t.bars_daily(spark, d), t.market_daily(spark, d)))
    return rounded(x.select("sym", "d", factors.residual_deviation().alias("idio_vol")), bump=1e-9)


# ---- with fundamentals, events and sentiment
_sym = "'BRAND#' || (o_custkey % 25 + 1)"
_med = lambda c: f"coalesce({c}, median({c}) OVER x, 0)"
_sent = ["tone", "n_articles_log"]
FUND = f"""{feed_queries.FEED}, pan AS (SELECT sym, d, c / nullif(lag(c, 5) OVER (PARTITION BY sym ORDER BY d), 0) - 1 AS mom5 FROM px WHERE d <= (SELECT max(d) FROM feed) - 30),
earn AS (SELECT {_sym} AS sym, CAST(o_orderdate AS DATE) AS d, max(o_totalprice) / 200000.0 - 1 AS surprise FROM orders WHERE o_orderkey % 11 = 0 AND o_custkey % 25 <> 3 AND o_custkey % 25 <> 4 AND quarter(o_orderdate) <> 2 GROUP BY ALL),
e1 AS (SELECT *, CASE WHEN count(surprise) OVER b >= 2 THEN stddev_samp(surprise) OVER b END AS sd, surprise - lag(surprise) OVER s AS momentum, sign(surprise) AS sg, CASE WHEN sign(surprise) IS DISTINCT FROM lag(sign(surprise)) OVER s THEN 1 ELSE 0 END AS new FROM earn WINDOW s AS (PARTITION BY sym ORDER BY d), b AS (PARTITION BY sym ORDER BY d ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)),
e2 AS (SELECT *, sum(new) OVER (PARTITION BY sym ORDER BY d) AS run FROM e1), e3 AS (SELECT sym, d, surprise, greatest(least(CASE WHEN sd IS NOT NULL THEN surprise / (sd + 1e-6) END, 5), -5) AS sue0, sd, momentum, sg * row_number() OVER (PARTITION BY sym, run ORDER BY d) AS streak FROM e2),
e4 AS (SELECT sym, d, surprise, CASE WHEN sd IS NOT NULL THEN sue0 END AS sue, momentum, streak FROM e3),
j1 AS (SELECT p.sym, p.d, e.*  EXCLUDE (sym, d), date_diff('day', e.d, p.d) AS age, p.sym IN (SELECT sym FROM earn) AS listed FROM pan p ASOF LEFT JOIN e4 e ON e.sym = p.sym AND p.d >= e.d),
j2 AS (SELECT sym, d, CASE WHEN age <= 60 THEN age::DOUBLE END AS days_since_earnings, CASE WHEN age <= 60 THEN surprise END AS s, CASE WHEN age <= 60 THEN surprise * greatest(0, 1 - age / 60) END AS pead_signal, {', '.join(f"CASE WHEN age <= 60 THEN {c} * greatest(0, 1 - age / 60) WHEN listed THEN 0 END AS {n}" for c, n in (('sue', 'sue_signal'), ('momentum', 'surprise_momentum'), ('streak', 'surprise_streak')))} FROM j1),
j3 AS (SELECT *, CASE WHEN s IS NOT NULL THEN (rank() OVER (PARTITION BY d ORDER BY s NULLS LAST) + (count(*) OVER (PARTITION BY d, s) - 1) / 2.0) / count(s) OVER (PARTITION BY d) END AS pead_quintile_rank FROM j2),
sen AS (SELECT {_sym} AS sym, CAST(o_orderdate AS DATE) AS d, ln(1 + count(*)) AS n_articles_log, min(o_totalprice) / 1e5 AS tone FROM orders WHERE o_orderdate >= DATE '1995-01-01' GROUP BY ALL)
SELECT p.sym, p.d, round(p.mom5 + 1e-9, 6) + 0.0 AS mom5, {', '.join(f'round({_med(f"f.{c}")} + 1e-9, 6) + 0.0 AS {c}' for c in equity.FUND)}, {', '.join(f'round({_med(f"j3.{c}")}, 5) + 0.0 AS {c}' for c in [*equity.DRIFT, *equity.SURPRISE])}, {', '.join(f'round({_med(f"sen.{c}")} + 1e-9, 6) + 0.0 AS {c}' for c in _sent)}
FROM pan p LEFT JOIN feed f ON f.sym = p.sym AND f.d = p.d LEFT JOIN j3 ON j3.sym = p.sym AND j3.d = p.d LEFT JOIN sen ON sen.sym = p.sym AND sen.d = p.d WINDOW x AS (PARTITION BY p.d)"""


@query(FUND)
def fund_panel(spark, d):
    """A small panel with the daily fundamentals, drift and surprises after orders as announcements, and sentiment from 1995 on;
    the panel's last month, which the feed may not cover, is left out before."""
    feed_ = feed_queries._feed(spark, d)
    prices = feed_queries._prices(spark, d)
    from tessera.functions import windows as w

    pan = prices.select("sym", "d", (F.try_divide("c", w.lag("c", 5)) - 1).alias("mom5")).join(F.broadcast(feed_.agg(F.date_sub(F.max("d"), 30).alias("until"))), F.col("d") <= F.col("until")).drop("until")
    o = t.table(spark, d, "orders").withColumns({"sym": F.concat(F.lit("BRAND#"), F.col("o_custkey") % 25 + 1), "d": F.to_date("o_orderdate"), "n": F.col("o_custkey") % 25})
    earn = o.where("o_orderkey % 11 = 0 and n not in (3, 4) and quarter(d) <> 2").select("sym", "d", (F.col("o_totalprice") / 200000.0 - 1).alias("surprise"))
    sentiment = o.groupBy("sym", "d").agg(F.count("*").alias("n_articles"), (F.min("o_totalprice") / 1e5).alias("tone"))
    x = equity.fund_panel(pan, feed_, earn, sentiment, ["tone"], since="1995-01-01")
    six = {c: F.round(F.col(c) + 1e-9, 6) + 0.0 for c in ["mom5", *equity.FUND, *_sent]}
    return x.withColumns(six | {c: F.round(c, 5) + 0.0 for c in [*equity.DRIFT, *equity.SURPRISE]})
