"""Registered queries, sixth part: the panel of facts as first filed, with order lines as facts and parts as splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import as_filed, splits
from tessera.plans import sql
from tessera.plans.queries import query
from tessera.sources import tables as t

_TAGS = [c for tags in as_filed.FLOWS.values() for c in tags] + list(as_filed.BALANCES.values())
_tags = "[" + ", ".join(f"'{c}'" for c in _TAGS) + "]"
_flow = len(_TAGS) - 3  # tags before this one are flows
FACTS = f"""lines AS (SELECT p_brand AS sym, CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS b, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS qs, quarter(l_shipdate) AS qn, year(l_shipdate) * 4 + quarter(l_shipdate) AS q, CAST((l_orderkey + l_linenumber) % {len(_TAGS)} AS INTEGER) AS k, l.* FROM lineitem l JOIN part ON l_partkey = p_partkey),
facts AS (SELECT sym, {_tags}[k + 1] AS concept, CASE WHEN k >= {_flow} THEN NULL WHEN qn = 4 AND b % 4 <> 0 THEN make_date(year(qs), 1, 1) ELSE qs END AS start, CAST(qs + INTERVAL 3 MONTH AS DATE) - 1 AS "end",
  CAST(qs + INTERVAL 3 MONTH AS DATE) - 1 + CASE WHEN l_discount > 0.095 THEN -3 ELSE 25 + CAST(l_partkey % 40 AS INTEGER) END AS filed,
  CASE WHEN k = {_flow + 2} THEN round(l_extendedprice) * CASE WHEN l_tax > 0.075 AND l_quantity > 40 THEN 1000 ELSE 1 END ELSE round(l_extendedprice * 100) * CASE WHEN k = 0 AND l_tax > 0.06 THEN -1 ELSE 1 END END AS val
  FROM lines WHERE k >= {_flow} OR (b + q) % 5 <> 0),
sp AS (SELECT p_brand AS sym, DATE '1992-01-01' + CAST(p_partkey * 37 % 3300 AS INTEGER) AS d, CASE WHEN p_size % 2 = 0 THEN 2.0 ELSE 0.5 END::DOUBLE AS ratio FROM part WHERE p_partkey % 97 = 3),
fct AS (SELECT b.sym, b.d, round(coalesce(product(s.ratio), 1), 9) AS factor FROM bars b LEFT JOIN sp s ON s.sym = b.sym AND s.d > b.d WHERE year(b.d) >= 1994 GROUP BY ALL)"""
_pick = lambda name, when, order: f"{name} AS (SELECT sym, quantity, \"end\", filed, val FROM tagged WHERE {when} QUALIFY row_number() OVER (PARTITION BY sym, quantity, \"end\" ORDER BY {order}, val) = 1)"
_case = "CASE " + " ".join(f"WHEN concept IN ({', '.join(repr(c) for c in tags)}) THEN '{k}'" for k, tags in [*as_filed.FLOWS.items(), *((k, [c]) for k, c in as_filed.BALANCES.items())]) + " END"
SERIES = f"""{FACTS}, clean AS (SELECT * FROM facts WHERE "end" <= filed AND val IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sym, concept, start, "end" ORDER BY filed, val) = 1),
tagged AS (SELECT *, {_case} AS quantity, list_position({_tags}, concept) AS rank, date_diff('day', start, "end") AS span FROM clean),
{_pick('qtr', f"quantity IN ('ni', 'gp', 'rev', 'cost') AND span BETWEEN 80 AND 100", 'rank, filed')}, {_pick('ann', f"quantity IN ('ni', 'gp', 'rev', 'cost') AND span BETWEEN 350 AND 380", 'rank, filed')}, {_pick('inst', "quantity IN ('assets', 'equity', 'shares')", 'start IS NOT NULL, filed')},
q4 AS (SELECT a.sym, a.quantity, a."end", max(greatest(a.filed, q.filed)) AS filed, any_value(a.val) - sum(q.val) AS val FROM ann a JOIN qtr q ON q.sym = a.sym AND q.quantity = a.quantity AND q."end" > a."end" - 366 AND q."end" <= a."end" - 20
  WHERE NOT EXISTS (SELECT 1 FROM qtr z WHERE z.sym = a.sym AND z.quantity = a.quantity AND z."end" = a."end") GROUP BY ALL HAVING count(*) = 3),
qs4 AS (SELECT *, sum(val) OVER w AS s, max(filed) OVER w AS f, count(*) OVER w AS n, date_diff('day', lag("end", 3) OVER (PARTITION BY sym, quantity ORDER BY "end"), "end") AS gap FROM (FROM qtr UNION ALL FROM q4) WINDOW w AS (PARTITION BY sym, quantity ORDER BY "end" ROWS 3 PRECEDING)),
ttm AS (SELECT sym, quantity, "end", filed, val FROM ann UNION ALL SELECT sym, quantity, "end", f, s FROM qs4 z WHERE n = 4 AND gap BETWEEN 330 AND 400 AND NOT EXISTS (SELECT 1 FROM ann a WHERE a.sym = z.sym AND a.quantity = z.quantity AND a."end" = z."end")),
gpx AS (SELECT sym, "end", filed, val FROM ttm WHERE quantity = 'gp' UNION ALL SELECT r.sym, r."end", greatest(r.filed, c.filed), r.val - c.val FROM ttm r JOIN ttm c ON c.sym = r.sym AND c."end" = r."end" AND c.quantity = 'cost' WHERE r.quantity = 'rev' AND NOT EXISTS (SELECT 1 FROM ttm g WHERE g.quantity = 'gp' AND g.sym = r.sym AND g."end" = r."end")),
f0 AS (SELECT sym, min(d) AS d0, arg_min(factor, d) AS factor0 FROM fct GROUP BY sym),
sh0 AS (SELECT s.sym, s."end", s.filed, s.val, f.factor, f0.d0, f0.factor0 FROM inst s ASOF LEFT JOIN fct f ON f.sym = s.sym AND s."end" >= f.d LEFT JOIN f0 ON f0.sym = s.sym WHERE s.quantity = 'shares'),
sh1 AS (SELECT *, val * coalesce(factor, factor0 * coalesce((SELECT product(ratio) FROM sp WHERE sp.sym = sh0.sym AND sp.d > sh0."end" AND sp.d <= sh0.d0), 1)) AS adj FROM sh0),
sh2 AS (SELECT *, adj / lag(adj) OVER s AS p, adj / lead(adj) OVER s AS n, CASE WHEN count(adj) OVER m >= 3 THEN adj / median(adj) OVER m END AS l FROM sh1 WINDOW s AS (PARTITION BY sym ORDER BY "end"), m AS (PARTITION BY sym ORDER BY "end" ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
shx AS (SELECT sym, "end", filed, val, CASE WHEN coalesce((p > 1.5 AND n > 1.5) OR (p < 1 / 1.5 AND n < 1 / 1.5), FALSE) OR coalesce(l > 20 OR l < 1 / 20.0, FALSE) THEN NULL ELSE adj END AS adj FROM sh2)"""


def _series(tag: str, source: str, val: str = "val") -> str:
    return f"s_{tag} AS (SELECT sym, filed + 1 AS av, \"end\" AS fpe, {val} AS val FROM {source} WHERE {val} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sym, filed ORDER BY \"end\" DESC) = 1)"


_sources = [
    _series("ni", "(FROM ttm WHERE quantity = 'ni')"), _series("gp", "gpx"), _series("as", "(FROM inst WHERE quantity = 'assets')"), _series("eq", "(FROM inst WHERE quantity = 'equity')"),
    _series("sh", "shx", "adj"), _series("shraw", "shx"), "ag AS (SELECT sym, \"end\", filed, val, CASE WHEN date_diff('day', lag(\"end\", 4) OVER w, \"end\") BETWEEN 330 AND 400 THEN lag(val, 4) OVER w END AS before FROM inst WHERE quantity = 'assets' WINDOW w AS (PARTITION BY sym ORDER BY \"end\"))",
    _series("agn", "(FROM ag WHERE before IS NOT NULL)"), _series("agl", "ag", "before"),
]
_chain, _prev = [], "(SELECT sym, d, c AS price FROM bars WHERE sym IN (SELECT sym FROM clean))"
for _t in as_filed.TAGS:
    _chain.append(f"j_{_t} AS (SELECT b.*, x.val AS v_{_t}, x.av AS a_{_t}, x.fpe AS e_{_t} FROM {_prev} b ASOF LEFT JOIN s_{_t} x ON x.sym = b.sym AND b.d >= x.av)")
    _prev = f"j_{_t}"
_made = {
    "earnings_yield": ("v_ni", "mc", "ni sh", "ni"), "book_to_price": ("CASE WHEN abs(v_eq) > 1e5 THEN v_eq END", "mc", "eq sh", "eq"), "roe": ("v_ni", "CASE WHEN v_eq > 1e5 THEN v_eq END", "ni eq", "ni eq"),
    "gross_profitability": ("v_gp", "CASE WHEN v_as > 1e5 THEN v_as END", "gp as", "gp as"),
}
_most = lambda tags, p: f"greatest({', '.join(f'{p}_{x}' for x in tags.split())})" if " " in tags else f"{p}_{tags}"
_all = _made | {"asset_growth": ("", "", "agn", "agn")}
AS_FILED = f"""WITH {sql.BARS}, {SERIES}, {', '.join(_sources)}, {', '.join(_chain)},
g AS (SELECT *, CASE WHEN v_shraw > 1e3 THEN v_shraw END AS raw, CASE WHEN v_sh > 1e3 AND sym <> 'Brand#13' THEN v_sh END AS sh FROM {_prev}),
m AS (SELECT *, CASE WHEN sh * price > 1e6 THEN sh * price END AS mc, CASE WHEN raw * price > 1e6 THEN raw * price END AS mcraw, v_agn / CASE WHEN v_agl > 1e5 THEN v_agl END AS gr FROM g),
r AS (SELECT *, {', '.join(f"CASE WHEN abs({n} / nullif({q}, 0)) <= 1e6 THEN {n} / nullif({q}, 0) END AS {f}" for f, (n, q, _, _) in _made.items())}, CASE WHEN abs(gr) <= 1e6 THEN least(greatest(gr - 1, -0.99), 5) END AS asset_growth FROM m)
SELECT sym, d, round(price, 8) AS price, raw AS shares_asfiled, round(sh, 6) AS shares_adj, round(mc + 1e-4, 2) AS market_cap, round(mcraw + 1e-4, 2) AS market_cap_asfiled, {', '.join(f'round({f}, 9) + 0.0 AS {f}' for f in as_filed.FEATURES)},
  {', '.join(f"CASE WHEN {f} IS NOT NULL THEN {_most(a, 'a')} END AS {f}_available_at, CASE WHEN {f} IS NOT NULL THEN {_most(e, 'e')} END AS {f}_fiscal_period_end, CASE WHEN {f} IS NOT NULL THEN date_diff('day', {_most(a, 'a')}, d) END AS {f}_age_days" for f, (_, _, a, e) in _all.items())} FROM r"""


def _facts(spark, d):
    p = t.table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("sym"), F.regexp_replace("p_brand", "Brand#", "").cast("long").alias("b"))
    x = t.table(spark, d, "lineitem").join(p, F.col("l_partkey") == F.col("p_partkey"))
    qs = F.date_trunc("quarter", "l_shipdate").cast("date")
    x = x.withColumns({"qs": qs, "qn": F.quarter("l_shipdate"), "q": F.year("l_shipdate") * 4 + F.quarter("l_shipdate"), "k": ((F.col("l_orderkey") + F.col("l_linenumber")) % len(_TAGS)).cast("int")})
    k = F.col("k")
    x = x.where((k >= _flow) | ((F.col("b") + F.col("q")) % 5 != 0))
    start = F.when(k >= _flow, F.lit(None).cast("date")).when((F.col("qn") == 4) & (F.col("b") % 4 != 0), F.trunc("qs", "year")).otherwise(F.col("qs"))
    end = F.date_sub(F.add_months("qs", 3), 1)
    filed = F.date_add(end, F.when(F.col("l_discount") > 0.095, -3).otherwise(25 + (F.col("l_partkey") % 40).cast("int")))
    units = F.when((F.col("l_tax") > 0.075) & (F.col("l_quantity") > 40), 1000).otherwise(1)
    val = F.when(k == _flow + 2, F.round("l_extendedprice") * units).otherwise(F.round(F.col("l_extendedprice") * 100) * F.when((k == 0) & (F.col("l_tax") > 0.06), -1).otherwise(1))
    return x.select("sym", F.element_at(F.array(*map(F.lit, _TAGS)), k + 1).alias("concept"), start.alias("start"), end.alias("end"), filed.alias("filed"), val.alias("val"))


def _splits(spark, d):
    p = t.table(spark, d, "part").where("p_partkey % 97 = 3")
    return p.select(F.col("p_brand").alias("sym"), F.date_add(F.lit("1992-01-01").cast("date"), (F.col("p_partkey") * 37 % 3300).cast("int")).alias("d"), F.when(F.col("p_size") % 2 == 0, 2.0).otherwise(0.5).alias("ratio"))


@query(AS_FILED)
def as_filed_panel(spark, d):
    """The whole panel; some counts have wrong units, some splits come before the first factor, one symbol has no split basis."""
    bars = t.bars_daily(spark, d).select("sym", "d", "c")
    factors = splits.reconstructed(bars.where(F.year("d") >= 1994), _splits(spark, d)).withColumn("factor", F.round("factor", 9))
    failed = t.table(spark, d, "part").where("p_brand = 'Brand#13'").select(F.col("p_brand").alias("sym"))
    x = as_filed.panel(_facts(spark, d), bars, factors, _splits(spark, d), failed)
    caps = {c: F.round(F.col(c) + 1e-4, 2) for c in ("market_cap", "market_cap_asfiled")}  # off the half, where engines differ
    return x.withColumns(caps | {"price": F.round("price", 8), "shares_adj": F.round("shares_adj", 6)} | {c: F.round(c, 9) + 0.0 for c in as_filed.FEATURES})


@query(f"WITH {sql.BARS}, {SERIES} SELECT sym, \"end\", filed, val AS shares, round(adj, 6) AS adjusted FROM shx")
def adjusted_shares(spark, d):
    """Share counts as filed and on the adjusted basis, errors of units left out."""
    bars = t.bars_daily(spark, d).select("sym", "d")
    factors = splits.reconstructed(bars.where(F.year("d") >= 1994), _splits(spark, d)).withColumn("factor", F.round("factor", 9))
    rows = as_filed.by_quantity(as_filed.first_filed(_facts(spark, d)))
    return as_filed.share_counts(rows, factors, _splits(spark, d)).withColumn("adjusted", F.round("adjusted", 6))


@query(f"WITH {sql.BARS}, {SERIES}, n AS (SELECT sym, \"end\", filed, val FROM ttm WHERE quantity = 'ni') SELECT sym, \"end\", n.filed AS income_filed, n.val AS income, g.filed AS profit_filed, g.val AS profit FROM n FULL JOIN gpx g USING (sym, \"end\")")
def trailing_filed(spark, d):
    x = as_filed.trailing(as_filed.by_quantity(as_filed.first_filed(_facts(spark, d)))).where("ni is not null or gp is not null")
    return x.select("sym", "end", F.col("ni.filed").alias("income_filed"), F.col("ni.val").alias("income"), F.col("gp.filed").alias("profit_filed"), F.col("gp.val").alias("profit"))
