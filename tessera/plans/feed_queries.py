"""Registered queries, fourth part: the daily feed of fundamental ratios, its tiers of availability and its verdicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import feed
from tessera.plans import sql
from tessera.plans.queries import query
from tessera.sources import tables as t

_C = feed.CONCEPTS
_names = "[" + ", ".join(f"'{c}'" for c in _C) + "]"
#: Order lines as facts: twelve filers, a concept for each line, quarters by ship date; a third of a filer's quarters has
#: filing days, a third only the vendor's, a third none. Shares are stated once a year, other concepts in three quarters of four.
FACTS = f"""lines AS (SELECT *, CAST(date_trunc('quarter', l_shipdate) + INTERVAL 3 MONTH AS DATE) - 1 AS period_end, l_suppkey % 12 AS cik, CAST((l_orderkey + l_linenumber) % {len(_C)} AS INTEGER) AS k, (year(l_shipdate) * 4 + quarter(l_shipdate)) AS q FROM lineitem),
facts AS (SELECT cik, period_end, {_names}[k + 1] AS concept, CASE WHEN (cik + q) % 3 = 0 AND l_linenumber <> 7 THEN period_end + 20 + CAST(l_partkey % 30 AS INTEGER) END AS filed,
  CASE WHEN l_discount > 0 THEN CASE WHEN k = 0 AND l_tax > 0.05 THEN -l_extendedprice ELSE l_extendedprice END END AS val
  FROM lines WHERE CASE WHEN k BETWEEN 5 AND 8 THEN q % 4 = 0 ELSE (cik + q + k) % 4 <> 0 END),
ciks AS (SELECT DISTINCT CAST(replace(p_brand, 'Brand#', '') AS BIGINT) % 12 AS cik, p_brand AS sym FROM part),
vendor AS (SELECT sym, CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH AS DATE) - 1 AS period_end, CAST(o_orderdate AS DATE) + 70 + CAST(o_orderkey % 50 AS INTEGER) AS accepted, CAST(o_orderdate AS DATE) + 90 AS filed
  FROM orders JOIN ciks ON o_custkey % 12 = cik WHERE (cik + year(o_orderdate) * 4 + quarter(o_orderdate)) % 3 = 1)"""
_value = lambda c: f"max(CASE WHEN concept = '{c}' THEN val END) AS {c}"
QUARTERLY = f"""{FACTS}, newest AS (SELECT * FROM facts WHERE val IS NOT NULL QUALIFY row_number() OVER (PARTITION BY cik, period_end, concept ORDER BY filed DESC NULLS FIRST, val DESC) = 1),
wide AS (SELECT cik, period_end, {', '.join(map(_value, _C))}, max(filed) AS filed FROM (SELECT DISTINCT cik, period_end FROM facts) LEFT JOIN newest USING (cik, period_end) GROUP BY ALL),
acc AS (SELECT sym, period_end, max(greatest(accepted, filed)) AS accepted FROM vendor WHERE greatest(accepted, filed) >= period_end GROUP BY ALL),
named AS (SELECT c.sym, w.* FROM wide w JOIN ciks c USING (cik)),
qq AS (SELECT upper(n.sym) AS sym, n.period_end, {', '.join(_C)}, coalesce(filed, accepted, n.period_end + 60) AS available, CASE WHEN filed IS NOT NULL THEN 'filed' WHEN accepted IS NOT NULL THEN 'accepted' ELSE 'expected' END AS source
  FROM named n LEFT JOIN acc a ON a.sym = n.sym AND a.period_end = n.period_end)"""
PRICES = "px AS (SELECT upper(sym) AS sym, d, c FROM bars WHERE sym NOT IN ('Brand#7') AND (CAST(replace(sym, 'Brand#', '') AS BIGINT) + dayofyear(d)) % 5 <> 0)"


def _facts(spark, d):
    x = t.table(spark, d, "lineitem").withColumn("period_end", F.date_sub(F.add_months(F.date_trunc("quarter", "l_shipdate").cast("date"), 3), 1))
    x = x.withColumns({"cik": F.col("l_suppkey") % 12, "k": ((F.col("l_orderkey") + F.col("l_linenumber")) % len(_C)).cast("int"), "q": F.year("l_shipdate") * 4 + F.quarter("l_shipdate")})
    x = x.where(F.when(F.col("k").between(5, 8), F.col("q") % 4 == 0).otherwise((F.col("cik") + F.col("q") + F.col("k")) % 4 != 0))
    filed = F.when(((F.col("cik") + F.col("q")) % 3 == 0) & (F.col("l_linenumber") != 7), F.date_add("period_end", 20 + (F.col("l_partkey") % 30).cast("int")))
    val = F.when(F.col("l_discount") > 0, F.when((F.col("k") == 0) & (F.col("l_tax") > 0.05), -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")))
    concept = F.element_at(F.array(*map(F.lit, _C)), F.col("k") + 1)
    return x.select("cik", "period_end", concept.alias("concept"), filed.alias("filed"), val.alias("val"))


def _ciks(spark, d):
    return t.table(spark, d, "part").select((F.regexp_replace("p_brand", "Brand#", "").cast("long") % 12).alias("cik"), F.col("p_brand").alias("sym")).distinct()


def _vendor(spark, d):
    o = t.table(spark, d, "orders").withColumn("cik", F.col("o_custkey") % 12).join(F.broadcast(_ciks(spark, d)), "cik")  # one row for each brand
    o = o.where((F.col("cik") + F.year("o_orderdate") * 4 + F.quarter("o_orderdate")) % 3 == 1)
    end = F.date_sub(F.add_months(F.date_trunc("quarter", "o_orderdate").cast("date"), 3), 1)
    day = F.to_date("o_orderdate")
    return o.select("sym", end.alias("period_end"), F.date_add(day, 70 + (F.col("o_orderkey") % 50).cast("int")).alias("accepted"), F.date_add(day, 90).alias("filed"))


def _prices(spark, d):
    """Daily closes with gaps, so that the axis has days on which a symbol has none; one symbol has no prices at all."""
    b = t.bars_daily(spark, d).select(F.upper("sym").alias("sym"), "d", "c", F.regexp_replace("sym", "Brand#", "").cast("long").alias("n"))
    return b.where((F.col("n") != 7) & ((F.col("n") + F.dayofyear("d")) % 5 != 0)).select("sym", "d", "c")


def _feed(spark, d):
    return feed.daily(_facts(spark, d), _prices(spark, d), _ciks(spark, d), _vendor(spark, d))


@query(f"WITH {QUARTERLY} SELECT * FROM qq")
def quarterly_tiers(spark, d):
    return feed.quarterly(_facts(spark, d), _ciks(spark, d), _vendor(spark, d))


_first = lambda tags, what: f"coalesce({', '.join(f'{c}{what}' for c in tags)})"
_which = lambda tags, what: "CASE " + " ".join(f"WHEN {c} IS NOT NULL THEN {c}_{what}" for c in tags) + " END"


def _operand(name: str, tags: list[str]) -> str:
    return f"{_first(tags, '')} AS {name}, {_which(tags, 'av')} AS {name}_av, {_which(tags, 'pe')} AS {name}_pe"


def _older(a: str, b: str, what: str) -> str:
    return f"CASE WHEN {b}_av IS NULL OR {a}_av <= {b}_av THEN {a}_{what} ELSE {b}_{what} END"


_two = {"earnings_yield": ("ni", "sh"), "book_to_price": ("eq", "sh"), "gross_profitability": ("gp", "ta"), "roe": ("ni", "eq")}
_ratio = {"earnings_yield": ("ni", "sh * price"), "book_to_price": ("eq", "sh * price"), "gross_profitability": ("gp", "ta"), "roe": ("ni", "eq")}
_given = lambda f: f"CASE WHEN abs({_ratio[f][0]} / nullif({_ratio[f][1]}, 0)) <= 1e6 THEN {_ratio[f][0]} / nullif({_ratio[f][1]}, 0) END"
FEED = f"""WITH {sql.BARS}, {PRICES}, {QUARTERLY},
car AS (SELECT sym, available, period_end, source, {', '.join(f"last_value({c} IGNORE NULLS) OVER w AS {c}, last_value(CASE WHEN {c} IS NOT NULL THEN available END IGNORE NULLS) OVER w AS {c}_av, last_value(CASE WHEN {c} IS NOT NULL THEN period_end END IGNORE NULLS) OVER w AS {c}_pe" for c in _C)}
  FROM qq WINDOW w AS (PARTITION BY sym ORDER BY available, period_end)),
one AS (SELECT * FROM car QUALIFY row_number() OVER (PARTITION BY sym, available ORDER BY period_end DESC) = 1),
axis AS (SELECT sym, d FROM (SELECT DISTINCT sym FROM px WHERE sym IN (SELECT sym FROM qq)) s, (SELECT DISTINCT d FROM px) days),
j AS (SELECT a.sym, a.d, p.c AS price, o.* EXCLUDE (sym) FROM axis a LEFT JOIN px p ON p.sym = a.sym AND p.d = a.d ASOF LEFT JOIN one o ON o.sym = a.sym AND a.d >= o.available),
op AS (SELECT sym, d, price, period_end, available, source, {_operand('ni', feed.INCOME)}, {_operand('gd', feed.GROSS_PROFIT)}, {_operand('ta', feed.ASSETS)}, {_operand('eq', feed.EQUITY)}, {_operand('sh', feed.SHARES)}, {_operand('rv', feed.REVENUE)}, {_operand('cs', feed.COST)} FROM j),
gpr AS (SELECT *, CASE WHEN gd IS NOT NULL THEN gd ELSE rv - cs END AS gp, CASE WHEN gd IS NOT NULL THEN gd_av ELSE {_older('rv', 'cs', 'av')} END AS gp_av, CASE WHEN gd IS NOT NULL THEN gd_pe ELSE {_older('rv', 'cs', 'pe')} END AS gp_pe, lag(ta, 252) OVER (PARTITION BY sym ORDER BY d) AS before FROM op),
feed AS (SELECT sym, d, {', '.join(f'{_given(f)} AS {f}' for f in _ratio)}, CASE WHEN before <> 0 THEN least(greatest(ta / before - 1, -0.99), 5) WHEN before = 0 AND ta <> 0 THEN CASE WHEN ta > 0 THEN 5 ELSE -0.99 END END AS asset_growth,
  {', '.join(f"{_older(a, b, 'av')} AS {f}_source_available_at, {_older(a, b, 'pe')} AS {f}_source_fiscal_period_end" for f, (a, b) in _two.items())}, ta_av AS asset_growth_source_available_at, ta_pe AS asset_growth_source_fiscal_period_end,
  price, period_end AS fiscal_period_end, available AS available_at, source AS available_source FROM gpr)"""
_age = ", ".join(f"date_diff('day', {f}_source_available_at, d) AS {f}_source_age_days" for f in feed.FEATURES)


@query(f"{FEED} SELECT sym, d, {', '.join(f'round({f}, 9) + 0.0 AS {f}' for f in feed.FEATURES)}, {', '.join(f'{f}_source_available_at, {f}_source_fiscal_period_end' for f in feed.FEATURES)}, {_age}, round(price, 8) AS price, fiscal_period_end, available_at, available_source FROM feed")
def fundamentals_feed(spark, d):
    """The whole feed: three tiers of availability, dual share classes, provenance of each feature."""
    return _feed(spark, d).withColumns({c: F.round(c, 9) + 0.0 for c in feed.FEATURES} | {"price": F.round("price", 8)})


_have = lambda f: f"count({f}) AS h_{f}, count(CASE WHEN {f} IS NOT NULL AND date_diff('day', {f}_source_available_at, d) > 150 THEN 1 END) AS s_{f}"
_rows = " UNION ALL ".join(
    f"SELECT d, '{f}' AS feature, h_{f} AS n_have, {'n_priced' if f in feed.PRICED else 'n_served'} AS n_expected, {feed.FLOORS[f]} AS min_coverage, {feed.UNIVERSE_FLOORS[f]} AS universe_min_coverage, s_{f} AS n_stale, n_served, n_priced, n_universe FROM last, u" for f in feed.FEATURES
)
VERDICT = f"""{FEED}, last AS (SELECT d, count(DISTINCT sym) AS n_served, count(price) AS n_priced, {', '.join(map(_have, feed.FEATURES))} FROM feed WHERE d = (SELECT max(d) FROM feed) GROUP BY d),
u AS (SELECT count(DISTINCT upper(p_brand)) AS n_universe FROM part), r AS ({_rows}),
s AS (SELECT *, CASE WHEN n_expected > 0 THEN n_have / n_expected ELSE 0 END AS coverage, n_have / n_universe AS universe_coverage, CASE WHEN n_have > 0 THEN n_stale / n_have ELSE 0 END AS stale_fraction, n_priced / n_universe AS price_coverage FROM r),
v AS (SELECT *, coverage >= min_coverage AS ok, universe_coverage >= universe_min_coverage AS universe_ok, n_stale = 0 AS fresh_ok, price_coverage >= 0.5 AS price_ok FROM s)
SELECT d, feature, n_have, n_expected, round(coverage, 6) AS coverage, CAST(min_coverage AS DOUBLE) AS min_coverage, ok, round(universe_coverage, 6) AS universe_coverage, CAST(universe_min_coverage AS DOUBLE) AS universe_min_coverage, universe_ok, n_stale, round(stale_fraction, 6) AS stale_fraction, fresh_ok,
  n_served, n_priced, n_universe, round(price_coverage, 6) AS price_coverage, price_ok, bool_and(ok AND universe_ok AND price_ok) OVER () AS coverage_ok, bool_and(fresh_ok) OVER () AS freshness_ok FROM v"""


def _verdict(spark, d):
    x = feed.verdict(_feed(spark, d), t.table(spark, d, "part").select(F.col("p_brand").alias("sym")))
    return x.withColumns({c: F.round(c, 6) for c in ("coverage", "universe_coverage", "stale_fraction", "price_coverage")})


@query(VERDICT)
def feed_verdict(spark, d):
    return _verdict(spark, d)


@query(f"SELECT d, feature, n_have AS n_checked, n_stale, stale_fraction, fresh_ok, freshness_ok FROM ({VERDICT})")
def feature_freshness(spark, d):
    """Finite values on the last day served, and how many of them rest on a source older than the limit."""
    return _verdict(spark, d).select("d", "feature", F.col("n_have").alias("n_checked"), "n_stale", "stale_fraction", "fresh_ok", "freshness_ok")
