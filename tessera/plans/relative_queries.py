"""Registered queries, eighth part: indicators against a benchmark, with SQL that recurs over the rows of all symbols at once."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tessera.operators import relative
from tessera.plans import sql
from tessera.plans.queries import query
from tessera.sources import tables as t

BENCH = "Brand#11"
_w = lambda c, n: f"CASE WHEN r.{c} IS NULL THEN x.{c} ELSE x.{c} / {n} + r.{c} * {n - 1} / {n} END AS {c}"
_e = lambda c, n, of="x", p="r": f"{of}.{c} * 2 / {n + 1} + {p}.{c} * {n - 1} / {n + 1} AS {c}"


def _range(x: str, n: int) -> str:
    mean = f"list_avg({x})"
    sums = f"list_transform(range(1, {n + 1}), lambda i: list_sum(({x})[1:i]) - i * {mean})"
    return f"((list_max({sums}) - list_min({sums})) / nullif(sqrt(list_avg(list_transform({x}, lambda v: (v - {mean}) * (v - {mean})))), 0))"


_rs7 = f"list_avg(list_filter([{', '.join(_range(f'a[{7 * k + 1}:{7 * k + 7}]', 7) for k in range(9))}], lambda z: z IS NOT NULL))"
FRAME = f"""WITH RECURSIVE {sql.BARS}, y AS (SELECT *, row_number() OVER s AS k, c - lag(c) OVER s AS dc, h - lag(h) OVER s AS up, lag(l) OVER s - l AS dn, greatest(h - l, abs(h - lag(c) OVER s), abs(l - lag(c) OVER s)) AS a, (h + l + c) / 3 AS tp, c / nullif(lag(c) OVER s, 0) - 1 AS ret FROM bars WINDOW s AS (PARTITION BY sym ORDER BY d)),
x AS (SELECT sym, d, k, CASE WHEN dc IS NOT NULL THEN greatest(dc, 0) END AS g, CASE WHEN dc IS NOT NULL THEN greatest(-dc, 0) END AS b, a, CASE WHEN up > dn AND up > 0 THEN up ELSE 0 END AS p, CASE WHEN dn > up AND dn > 0 THEN dn ELSE 0 END AS m, sum(coalesce(sign(dc), 0) * v) OVER (PARTITION BY sym ORDER BY d) AS o, c AS f, c AS s, c AS e50 FROM y),
r AS (SELECT * FROM x WHERE k = 1 UNION ALL SELECT x.sym, x.d, x.k, {', '.join(_w(c, 14) for c in 'gbapm')}, {_e('o', 20)}, {_e('f', 12)}, {_e('s', 26)}, {_e('e50', 50)} FROM r JOIN x ON r.sym = x.sym AND x.k = r.k + 1),
i AS (SELECT *, CASE WHEN k >= 14 THEN 100 * abs(p / nullif(a, 0) - m / nullif(a, 0)) / nullif(p / nullif(a, 0) + m / nullif(a, 0), 0) END AS dx, f - s AS macd FROM r),
z AS (SELECT sym, k, dx, macd FROM i WHERE k = 1 UNION ALL SELECT i.sym, i.k, CASE WHEN r.dx IS NULL THEN i.dx ELSE i.dx / 14 + r.dx * 13 / 14 END, {_e('macd', 9, 'i').replace(' AS macd', '')} FROM z r JOIN i ON i.sym = r.sym AND i.k = r.k + 1),
wd AS (SELECT sym, d, c, ret, list(tp) OVER w20 AS tps, avg(tp) OVER w20 AS tpm, tp, count(*) OVER w20 AS n20, (c - avg(c) OVER w20) / nullif(2 * stddev_samp(c) OVER w20, 0) AS bbp, -100 * (max(h) OVER w14 - c) / nullif(max(h) OVER w14 - min(l) OVER w14, 0) AS wr, count(*) OVER w14 AS n14 FROM y WINDOW w20 AS (PARTITION BY sym ORDER BY d ROWS 19 PRECEDING), w14 AS (PARTITION BY sym ORDER BY d ROWS 13 PRECEDING)),
ind AS (SELECT i.sym, i.d, wd.c, wd.ret, CASE WHEN i.k >= 15 THEN 100 - 100 / (1 + i.g / nullif(i.b, 0)) END AS rsi, i.macd - z.macd AS macd_hist, CASE WHEN n20 = 20 THEN (tp - tpm) / nullif(0.015 * list_avg(list_transform(tps, lambda v: abs(v - tpm))), 0) END AS cci, CASE WHEN n20 = 20 THEN bbp END AS bbp, CASE WHEN i.k >= 27 THEN z.dx END AS adx, CASE WHEN n14 = 14 THEN wr END AS williams_r,
  (i.o - lag(i.o, 5) OVER q) / nullif(lag(i.o, 5) OVER q, 0) AS obv_slope, i.e50 FROM i JOIN z ON z.sym = i.sym AND z.k = i.k JOIN wd ON wd.sym = i.sym AND wd.d = i.d WINDOW q AS (PARTITION BY i.sym ORDER BY i.d)),
ok AS (SELECT * FROM ind WHERE {' AND '.join(f'{c} IS NOT NULL' for c in relative.INDICATORS)}),
ctx AS (SELECT d, coalesce(CASE WHEN count(ret) OVER v20 = 20 THEN stddev_samp(ret) OVER v20 * sqrt(252) END, 0) AS spy_realized_vol, coalesce(adx, 25) AS spy_adx, coalesce(c / nullif(e50, 0), 1) AS spy_trend, CASE WHEN count(ret) OVER v63 = 63 THEN list(ret) OVER v63 END AS a FROM ind WHERE sym = '{BENCH}' WINDOW v20 AS (ORDER BY d ROWS 19 PRECEDING), v63 AS (ORDER BY d ROWS 62 PRECEDING)),
hst AS (SELECT * EXCLUDE (a), coalesce((ln({_range('a', 63)}) - ln({_rs7})) / {2 * math.log(3)}, 0) AS hurst FROM ctx),
j AS (SELECT o.sym, o.d, o.c, {', '.join(f'o.{c}' for c in relative.INDICATORS)}, m.c AS m_c, {', '.join(f'm.{c} AS m_{c}' for c in relative.INDICATORS)}, {', '.join(f'hst.{c}' for c in relative.CONTEXT)}, row_number() OVER (PARTITION BY o.sym ORDER BY o.d) AS k FROM ok o JOIN ok m ON m.sym = '{BENCH}' AND m.d = o.d JOIN hst ON hst.d = o.d QUALIFY count(*) OVER (PARTITION BY o.sym) >= 10),
em AS (SELECT sym, k, c AS e50, c AS e200 FROM j WHERE k = 1 UNION ALL SELECT j.sym, j.k, j.c * 2 / 51 + e.e50 * 49 / 51, j.c * 2 / 201 + e.e200 * 199 / 201 FROM em e JOIN j ON j.sym = e.sym AND j.k = e.k + 1),
fr AS (SELECT j.sym, j.d, j.c AS close, {', '.join(f'j.{c} / nullif(j.m_{c}, 0) AS {c}' if c in relative.RATIOS else f'j.{c} - j.m_{c} AS {c}' for c in relative.INDICATORS)}, j.c / nullif(em.e50, 0) AS trend, j.c / nullif(em.e200, 0) AS trend_long,
  {', '.join(f'(j.c / nullif(m_c, 0)) / nullif(lag(j.c / nullif(m_c, 0), {n}) OVER q, 0) - 1 AS rel_mom_{n}d' for n in (20, 60))}, {', '.join(relative.CONTEXT)} FROM j JOIN em ON em.sym = j.sym AND em.k = j.k WINDOW q AS (PARTITION BY j.sym ORDER BY j.d))"""
_columns = [*relative.INDICATORS, "trend", "trend_long", "rel_mom_20d", "rel_mom_60d", *relative.CONTEXT]


@query(f"{FRAME} SELECT sym, d, round(close, 8) AS close, {', '.join(f'round({c}, 6) + 0.0 AS {c}' for c in _columns)} FROM fr WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _columns)}")
def relative_strength(spark, d):
    """Every brand against one of them."""
    bars = t.bars_daily(spark, d)
    x = relative.frame(bars, bars.where(F.col("sym") == BENCH))
    return x.withColumns({c: F.round(c, 6) + 0.0 for c in _columns} | {"close": F.round("close", 8)})


@query(f"{FRAME} SELECT d, {', '.join(f'round({c}, 6) + 0.0 AS {c}' for c in relative.CONTEXT)} FROM hst")
def market_context(spark, d):
    """The benchmark's state on each of its days, by bars up to that day."""
    x = relative.context(t.bars_daily(spark, d).where(F.col("sym") == BENCH))
    return x.select("d", *((F.round(c, 6) + 0.0).alias(c) for c in relative.CONTEXT))
