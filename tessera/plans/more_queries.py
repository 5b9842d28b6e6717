"""Registered queries, second part: fundamentals, events, indicators, factors, bars, screening, splits, revisions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import scalars
from tessera.functions import windows as w
from tessera.operators import asof
from tessera.operators import bars as b
from tessera.operators import events, factors, fundamentals, revisions, screen, splits, technical
from tessera.plans import sql
from tessera.plans.queries import query, rounded
from tessera.sources import tables as t



CONCEPTS = ["c1", "c2", "c3", "c4", "c5"]
_listed = ", ".join(CONCEPTS)
FACTS = f"""names AS (SELECT event_type, row_number() OVER (ORDER BY event_type) AS k FROM (SELECT DISTINCT event_type FROM events)),
facts AS (SELECT user_id AS sym, CAST(date_trunc('week', ts) AS DATE) AS period_end, ts AS filed, 'c' || k AS concept, value AS val, event_id FROM events JOIN names USING (event_type)),
last AS (SELECT sym, period_end, concept, val, filed FROM facts WHERE val IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sym, period_end, concept ORDER BY filed DESC, event_id DESC, val DESC) = 1),
wide AS (SELECT sym, period_end, {", ".join(f"max(CASE WHEN concept = '{c}' THEN val END) AS {c}" for c in CONCEPTS)}, CAST(max(filed) AS DATE) AS available FROM last GROUP BY 1, 2)"""
CARRIED = f"""filled AS (SELECT sym, available, period_end, {", ".join(f"last_value({c} IGNORE NULLS) OVER a AS {c}" for c in CONCEPTS)} FROM wide WINDOW a AS (PARTITION BY sym ORDER BY available, period_end)),
carried AS (SELECT * FROM filled QUALIFY row_number() OVER (PARTITION BY sym, available ORDER BY period_end DESC) = 1)"""


def _wide(spark, d):
    """All event types as concepts, named by their place in order of name."""
    names = t.table(spark, d, "events").select("event_type").distinct()
    names = names.select(F.col("event_type").alias("concept"), F.concat(F.lit("c"), F.row_number().over(Window.orderBy("event_type"))).alias("code"))  # a row for each type
    facts = t.facts(spark, d).join(F.broadcast(names), "concept").withColumn("concept", F.col("code")).drop("code")
    return fundamentals.latest_pivot(facts, CONCEPTS)


def _calendar(spark, d):
    """Every user on every day of the events: a few thousand users by thirty days, made by exploding the array of days."""
    days = t.table(spark, d, "events").agg(F.sequence(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).alias("days"))  # one row
    users = t.table(spark, d, "events").select(F.col("user_id").alias("sym")).distinct()
    return users.join(F.broadcast(days), F.lit(True)).select("sym", F.explode("days").alias("d"))


@query(f"WITH {FACTS} SELECT sym, period_end, {_listed}, available, 'filed' AS source FROM wide")
def eav_latest_pivot(spark, d):
    return _wide(spark, d)


@query(f"WITH {FACTS}, {CARRIED}, days AS (SELECT DISTINCT user_id AS sym, CAST(unnest(generate_series((SELECT min(ts)::DATE FROM events), (SELECT max(ts)::DATE FROM events), INTERVAL 1 DAY)) AS DATE) AS d FROM events) SELECT x.sym, x.d, c.period_end, {", ".join(f"c.{c}" for c in CONCEPTS)} FROM days x ASOF LEFT JOIN carried c ON x.sym = c.sym AND x.d >= c.available")
def pit_daily(spark, d):
    return fundamentals.to_daily(fundamentals.carry_forward(_wide(spark, d), CONCEPTS), _calendar(spark, d))


@query(f"WITH {FACTS}, r AS (SELECT *, c1 / nullif(c2, 0) AS q FROM wide) SELECT sym, period_end, round(CASE WHEN abs(q) <= 10 THEN q END, 6) AS ratio, coalesce(c1, c2, c3) AS value, CASE WHEN c1 IS NOT NULL THEN 'c1' WHEN c2 IS NOT NULL THEN 'c2' WHEN c3 IS NOT NULL THEN 'c3' END AS tag, CASE WHEN abs(c3) > 5 THEN c3 END AS guarded FROM r")
def safe_ratio_coalesce(spark, d):
    c = F.col
    value, tag = scalars.first_known((c("c1"), "c1"), (c("c2"), "c2"), (c("c3"), "c3"))
    return rounded(_wide(spark, d).select("sym", "period_end", scalars.safe_ratio(c("c1"), c("c2"), 10).alias("ratio"), value.alias("value"), tag.alias("tag"), scalars.guard(c("c3"), 5).alias("guarded")))


@query(f"WITH {FACTS}, n AS (SELECT count(*) AS n_today FROM wide WHERE period_end = (SELECT max(period_end) FROM wide)), e AS (SELECT count(DISTINCT sym) AS ever FROM wide), f AS (SELECT unnest({CONCEPTS}) AS feature), k AS (SELECT feature, count(CASE feature {" ".join(f"WHEN '{c}' THEN {c}" for c in CONCEPTS)} END) AS n FROM f, wide WHERE period_end = (SELECT max(period_end) FROM wide) GROUP BY feature) SELECT feature, n, round(n / (SELECT count(DISTINCT c_custkey % 200) FROM customer)::DOUBLE, 6) AS of_universe, round(n / n_today::DOUBLE, 6) AS of_today, round(n / ever::DOUBLE, 6) AS of_ever FROM k, n, e")
def coverage_report(spark, d):
    return rounded(fundamentals.coverage(_wide(spark, d).withColumnRenamed("period_end", "d"), CONCEPTS, t.table(spark, d, "customer").select((F.col("c_custkey") % 200).alias("sym"))))


_DAYS = "days AS (SELECT DISTINCT user_id AS sym, CAST(unnest(generate_series((SELECT min(ts)::DATE FROM events), (SELECT max(ts)::DATE FROM events), INTERVAL 1 DAY)) AS DATE) AS d FROM events)"


@query(f"WITH {FACTS}, {CARRIED}, {_DAYS}, j AS (SELECT x.d, c.available FROM days x ASOF LEFT JOIN carried c ON x.sym = c.sym AND x.d >= c.available) SELECT (SELECT count(CASE WHEN available > d THEN 1 END) FROM j) AS used_before_known, count(CASE WHEN period_end > available THEN 1 END) AS known_before_end, count(*) AS n_rows FROM carried")
def pit_violations(spark, d):
    """Use is checked on every day of the daily panel, in which each value has the day it became available; the rest on
    the carried rows."""
    carried = fundamentals.carry_forward(_wide(spark, d), CONCEPTS, known=True)
    used = fundamentals.used_early(fundamentals.to_daily(carried, _calendar(spark, d)), CONCEPTS)
    rest = fundamentals.point_in_time_violations(carried.withColumn("available", F.col("d"))).drop("used_before_known")
    return used.crossJoin(rest)


@query(f"WITH {FACTS}, {_DAYS}, j AS (SELECT x.d, w.period_end, w.available FROM days x ASOF LEFT JOIN wide w ON x.sym = w.sym AND x.d >= w.period_end) SELECT count(CASE WHEN available > d THEN 1 END) AS used_before_known, count(CASE WHEN period_end > available THEN 1 END) AS known_before_end, count(*) AS n_rows FROM j")
def pit_violations_naive(spark, d):
    """What the check counts on a panel that takes values from their period on, before they were filed."""
    naive = asof.asof_join(_calendar(spark, d), _wide(spark, d).select("sym", F.col("period_end").alias("d"), "period_end", "available"))
    return fundamentals.point_in_time_violations(naive)


# ---- events
EARN = """avgp AS (SELECT avg(o_totalprice) AS m FROM orders), earn AS (SELECT o_custkey AS sym, CAST(o_orderdate AS DATE) AS d, max(o_totalprice) / m - 1 AS surprise FROM orders, avgp GROUP BY 1, 2, m)"""
PANEL = "panel AS (SELECT DISTINCT sym, d + k AS d FROM earn, (VALUES (0), (1), (30), (70)) v(k))"


def _earn(spark, d):
    o = t.table(spark, d, "orders")
    most = o.groupBy(F.col("o_custkey").alias("sym"), F.col("o_orderdate").cast("date").alias("d")).agg(F.max("o_totalprice").alias("x"))
    mean = F.broadcast(o.agg(F.avg("o_totalprice").alias("m")))  # one row
    return most.join(mean, F.lit(True)).select("sym", "d", (F.col("x") / F.col("m") - 1).alias("surprise"))


def _panel(spark, d):
    k = F.explode(F.array(*map(F.lit, (0, 1, 30, 70)))).alias("k")
    return _earn(spark, d).select("sym", "d", k).select("sym", F.date_add("d", F.col("k")).alias("d")).distinct()


@query(f"""WITH {EARN}, x AS (SELECT *, CASE WHEN count(surprise) OVER p >= 2 THEN stddev_samp(surprise) OVER p END AS sd, lag(surprise) OVER s AS before, sign(surprise) AS sg,
  CASE WHEN sign(surprise) <> coalesce(lag(sign(surprise)) OVER s, 9) THEN 1 ELSE 0 END AS new FROM earn WINDOW s AS (PARTITION BY sym ORDER BY d), p AS (PARTITION BY sym ORDER BY d ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)),
y AS (SELECT *, sum(new) OVER (PARTITION BY sym ORDER BY d) AS run FROM x)
SELECT sym, d, round(surprise, 6) + 0.0 AS surprise, round(CASE WHEN sd IS NOT NULL THEN greatest(least(surprise / (sd + 1e-6), 5), -5) END, 5) + 0.0 AS sue, round(surprise - before, 6) + 0.0 AS momentum,
  CAST(sg * row_number() OVER (PARTITION BY sym, run ORDER BY d) AS DOUBLE) AS streak FROM y""")
def surprise_history(spark, d):
    x = events.surprise_history(_earn(spark, d))
    return rounded(x.withColumn("sue", F.round("sue", 5)))


@query(f"""WITH {EARN}, {PANEL}, j AS (SELECT p.sym, p.d, date_diff('day', e.d, p.d) AS age, e.surprise FROM panel p ASOF LEFT JOIN earn e ON p.sym = e.sym AND p.d >= e.d),
k AS (SELECT sym, d, CAST(CASE WHEN age <= 60 THEN age END AS DOUBLE) AS ds, CASE WHEN age <= 60 THEN surprise * greatest(0, 1 - age / 60.0::DOUBLE) END AS sg FROM j),
r AS (SELECT *, CASE WHEN sg IS NOT NULL THEN (rank() OVER (PARTITION BY d ORDER BY sg NULLS LAST) + (count(*) OVER (PARTITION BY d, sg) - 1) / 2.0) / count(sg) OVER (PARTITION BY d) END AS rk FROM k)
SELECT sym, d, round(coalesce(ds, median(ds) OVER w, 0), 6) AS days_since, round(coalesce(sg, median(sg) OVER w, 0), 6) + 0.0 AS signal, round(coalesce(rk, median(rk) OVER w, 0), 6) AS signal_rank FROM r WINDOW w AS (PARTITION BY d)""")
def pead_panel(spark, d):
    return rounded(events.drift_after(_panel(spark, d), _earn(spark, d)))


@query(f"WITH {EARN}, {PANEL} SELECT p.sym, p.d, round(e.surprise, 6) + 0.0 AS surprise, CASE WHEN e.d IS NOT NULL THEN CAST(least(greatest(date_diff('day', e.d, p.d), 0), 90) AS BIGINT) END AS days_since FROM panel p ASOF LEFT JOIN earn e ON p.sym = e.sym AND p.d >= e.d + 1")
def pead_next_day(spark, d):
    return rounded(events.drift_next_day(_panel(spark, d), _earn(spark, d)))


@query(f"WITH {EARN}, {PANEL}, s AS (SELECT sym, d + 1 AS d, sum(surprise) OVER (PARTITION BY sym ORDER BY d ROWS 3 PRECEDING) AS x FROM earn) SELECT p.sym, p.d, round(s.x, 6) + 0.0 AS surprise_sum FROM panel p ASOF LEFT JOIN s ON p.sym = s.sym AND p.d >= s.d")
def surprise_sum_4(spark, d):
    return rounded(events.trailing_surprise(_panel(spark, d), _earn(spark, d)))


@query("WITH x AS (SELECT l_suppkey AS sym, CAST(l_shipdate AS DATE) AS d, sum(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END) AS dollars FROM lineitem GROUP BY 1, 2) SELECT sym, d, round(sum(dollars) OVER (PARTITION BY sym ORDER BY d RANGE BETWEEN INTERVAL 89 DAY PRECEDING AND CURRENT ROW), 4) + 0.0 AS net_buy FROM x")
def insider_net_buy(spark, d):
    x = t.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("sym"), F.col("l_shipdate").cast("date").alias("d"), F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")).alias("dollars"))
    return rounded(events.net_buying(x), 4)


# ---- technical indicators
@query(f"""WITH {sql.BARS}, x AS (SELECT *, (h + l + c) / 3 AS tp, c / nullif(lag(c) OVER s, 0) - 1 AS r FROM bars WINDOW s AS (PARTITION BY sym ORDER BY d)), y AS (SELECT *, lag(r) OVER (PARTITION BY sym ORDER BY d) AS r1, list(tp) OVER w20 AS tps, avg(tp) OVER w20 AS tpm, count(*) OVER w20 AS k, count(*) OVER w14 AS k14, CASE WHEN lag(r) OVER (PARTITION BY sym ORDER BY d) IS NOT NULL THEN r END AS rb FROM x WINDOW w20 AS (PARTITION BY sym ORDER BY d ROWS 19 PRECEDING), w14 AS (PARTITION BY sym ORDER BY d ROWS 13 PRECEDING))
SELECT sym, d, round(CASE WHEN k = 20 THEN (tp - tpm) / nullif(0.015 * list_avg(list_transform(tps, lambda v: abs(v - tpm))), 0) END, 6) + 0.0 AS cci,
  round(CASE WHEN k = 20 THEN (c - avg(c) OVER w20) / nullif(2 * stddev_samp(c) OVER w20, 0) END, 6) + 0.0 AS bbp,
  round(CASE WHEN k14 = 14 THEN -100 * (max(h) OVER w14 - c) / nullif(max(h) OVER w14 - min(l) OVER w14, 0) END, 6) + 0.0 AS williams_r,
  round(CASE WHEN count(rb) OVER w19 = 19 THEN coalesce(covar_samp(rb, r1) OVER w19 / nullif(sqrt(var_samp(rb) OVER w19 * var_samp(CASE WHEN rb IS NOT NULL THEN r1 END) OVER w19), 0), 0) END, 6) + 0.0 AS autocorr
FROM y WINDOW w20 AS (PARTITION BY sym ORDER BY d ROWS 19 PRECEDING), w14 AS (PARTITION BY sym ORDER BY d ROWS 13 PRECEDING), w19 AS (PARTITION BY sym ORDER BY d ROWS 18 PRECEDING)""")
def technical_windows(spark, d):
    return rounded(technical.windowed(t.bars_daily(spark, d)))


def _ewm_sql(out: str, x: str, alpha: float) -> str:
    """An exponential mean as a fold over the values so far: alpha of the new one and the rest of what was."""
    return f"list_reduce(list({x}) OVER s, lambda a, y: {alpha} * y + {1 - alpha} * a) AS {out}"


@query(f"WITH {sql.BARS}, e AS (SELECT sym, d, {_ewm_sql('f', 'c', 2 / 13)}, {_ewm_sql('s_', 'c', 2 / 27)} FROM bars WINDOW s AS (PARTITION BY sym ORDER BY d)), m AS (SELECT sym, d, f - s_ AS macd FROM e), g AS (SELECT sym, d, macd, {_ewm_sql('sig', 'macd', 0.2)} FROM m WINDOW s AS (PARTITION BY sym ORDER BY d)) SELECT sym, d, round(macd - sig, 5) + 0.0 AS macd_hist FROM g")
def macd_histogram(spark, d):
    return rounded(technical.macd_histogram(t.bars_daily(spark, d)), 5)


@query(f"WITH {sql.BARS}, r AS (SELECT sym, d, greatest(h - l, abs(h - lag(c) OVER s), abs(l - lag(c) OVER s)) AS tr, row_number() OVER s AS k FROM bars WINDOW s AS (PARTITION BY sym ORDER BY d)), e AS (SELECT sym, d, k, {_ewm_sql('a', 'tr', 1 / 14)} FROM r WINDOW s AS (PARTITION BY sym ORDER BY d)) SELECT sym, d, round(CASE WHEN k >= 14 THEN a END, 5) AS atr FROM e")
def atr(spark, d):
    return rounded(technical.atr(t.bars_daily(spark, d)), 5)


_mean = lambda x, p="r", q="x": f"CASE WHEN {p}.{x} IS NULL THEN {q}.{x} ELSE {q}.{x} / 14 + {p}.{x} * 13 / 14 END AS {x}"
#: Recursion over the rows of all symbols at once.
RSI = f"""WITH RECURSIVE {sql.BARS}, y AS (SELECT *, row_number() OVER s AS k, c - lag(c) OVER s AS dc, h - lag(h) OVER s AS up, lag(l) OVER s - l AS dn, greatest(h - l, abs(h - lag(c) OVER s), abs(l - lag(c) OVER s)) AS a FROM bars WINDOW s AS (PARTITION BY sym ORDER BY d)),
x AS (SELECT sym, d, k, CASE WHEN dc IS NOT NULL THEN greatest(dc, 0) END AS g, CASE WHEN dc IS NOT NULL THEN greatest(-dc, 0) END AS b, a, CASE WHEN up > dn AND up > 0 THEN up ELSE 0 END AS p, CASE WHEN dn > up AND dn > 0 THEN dn ELSE 0 END AS m, sum(coalesce(sign(dc), 0) * v) OVER (PARTITION BY sym ORDER BY d) AS o FROM y),
r AS (SELECT * FROM x WHERE k = 1 UNION ALL SELECT x.sym, x.d, x.k, {", ".join(_mean(c) for c in "gbapm")}, x.o * 2 / 21 + r.o * 19 / 21 AS o FROM r JOIN x ON r.sym = x.sym AND x.k = r.k + 1),
i AS (SELECT *, CASE WHEN k >= 14 THEN 100 * abs(p / nullif(a, 0) - m / nullif(a, 0)) / nullif(p / nullif(a, 0) + m / nullif(a, 0), 0) END AS dx FROM r),
z AS (SELECT sym, k, dx FROM i WHERE k = 14 UNION ALL SELECT i.sym, i.k, {_mean("dx", "z", "i")} FROM z JOIN i ON i.sym = z.sym AND i.k = z.k + 1)
SELECT i.sym, i.d, round(CASE WHEN i.k >= 15 THEN 100 - 100 / (1 + g / nullif(b, 0)) END, 6) + 0.0 AS rsi, round(CASE WHEN i.k >= 27 THEN z.dx END, 6) + 0.0 AS adx,
  round((o - lag(o, 5) OVER s) / nullif(lag(o, 5) OVER s, 0), 6) + 0.0 AS obv_slope FROM i LEFT JOIN z ON i.sym = z.sym AND i.k = z.k WINDOW s AS (PARTITION BY i.sym ORDER BY i.d)"""


@query(RSI)
def rsi_adx_obv(spark, d):
    bars = t.bars_daily(spark, d)
    return rounded(technical.rsi(bars).join(technical.adx(bars), ["sym", "d"]).join(technical.obv_slope(bars), ["sym", "d"]))


@query(f"WITH {sql.BARS}, x AS (SELECT sym, d, CASE WHEN count(c) OVER w >= 50 THEN avg(c) OVER w END AS sma, count(*) OVER (PARTITION BY sym ORDER BY d) AS k FROM bars WINDOW w AS (PARTITION BY sym ORDER BY d ROWS 49 PRECEDING)) SELECT sym, d, round(sma, 8) AS sma FROM x WHERE sma > 0 AND k >= 60 QUALIFY row_number() OVER (PARTITION BY sym ORDER BY d DESC) = 1")
def sma_latest(spark, d):
    return technical.sma_latest(t.bars_daily(spark, d))


# ---- factors
FACTOR = f"""WITH {sql.BARS}, {sql.MARKET}, x AS (SELECT b.*, m.c AS m FROM bars b ASOF LEFT JOIN mkt m ON b.d >= m.d), y AS (SELECT *, c / lag(c) OVER s - 1 AS r, m / lag(m) OVER s - 1 AS rm, ln(v * c + 1) AS sz FROM x WINDOW s AS (PARTITION BY sym ORDER BY d)),
z AS (SELECT *, coalesce(CASE WHEN count(sz) OVER w60 = 60 THEN (sz - avg(sz) OVER w60) / nullif(stddev_samp(sz) OVER w60, 0) END, 0) AS z FROM y WINDOW w60 AS (PARTITION BY sym ORDER BY d ROWS 59 PRECEDING))"""


@query(f"""{FACTOR} SELECT sym, d, round(lag(c, 21) OVER s / lag(c, 252) OVER s - 1, 6) + 0.0 AS mom_12_1, round(CASE WHEN count(CASE WHEN rm IS NOT NULL THEN r END) OVER w252 >= 252 THEN covar_samp(r, rm) OVER w252 / nullif(var_samp(CASE WHEN r IS NOT NULL THEN rm END) OVER w252, 0) END, 6) + 0.0 AS beta,
  round(CASE WHEN count(r) OVER w60 >= 60 THEN sum(r * r) OVER w60 END, 6) AS variance, round(z, 6) + 0.0 AS size_z,
  round(CASE WHEN count(CASE WHEN rm IS NOT NULL THEN r END) OVER p60 >= 30 THEN covar_samp(r, rm) OVER p60 / nullif(var_samp(CASE WHEN r IS NOT NULL THEN rm END) OVER p60, 0) END, 6) + 0.0 AS beta_prior
FROM z WINDOW s AS (PARTITION BY sym ORDER BY d), w60 AS (PARTITION BY sym ORDER BY d ROWS 59 PRECEDING), w252 AS (PARTITION BY sym ORDER BY d ROWS 251 PRECEDING), p60 AS (PARTITION BY sym ORDER BY d ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING)""")
def market_factors(spark, d):
    x = factors.size_z(factors.with_market(t.bars_daily(spark, d), t.market_daily(spark, d)).withColumn("f", F.col("rm")))
    return rounded(x.select("sym", "d", factors.momentum().alias("mom_12_1"), factors.market_beta().alias("beta"), factors.variance().alias("variance"), F.col("z").alias("size_z"), factors.macro_beta().alias("beta_prior")))


_rz = lambda x: f"CASE WHEN count({x}) OVER w >= 15 THEN ({x} - avg({x}) OVER w) / nullif(stddev_samp({x}) OVER w, 0) END"


@query(f"WITH {sql.BARS}, x AS (SELECT sym, d, c, c / lag(c, 5) OVER s - 1 AS rel, c - lag(c, 5) OVER s AS diff FROM bars WINDOW s AS (PARTITION BY sym ORDER BY d)) SELECT sym, d, round({_rz('c')}, 6) + 0.0 AS level_z, round({_rz('rel')}, 6) + 0.0 AS chg_5d_z, round({_rz('diff')}, 6) + 0.0 AS diff_5d_z FROM x WINDOW w AS (PARTITION BY sym ORDER BY d ROWS 59 PRECEDING)")
def macro_z(spark, d):
    x = t.bars_daily(spark, d).select("sym", "d", "c", factors.change("c", 5, True).alias("rel"), factors.change("c", 5, False).alias("diff"))
    z = lambda c: factors.rolling_z(F.col(c), 60)
    return rounded(x.select("sym", "d", z("c").alias("level_z"), z("rel").alias("chg_5d_z"), z("diff").alias("diff_5d_z")))


# ---- bars
HOURS = "ticks AS (SELECT event_type AS sym, ts, event_id AS id, value AS price FROM events), hours AS (SELECT sym, date_trunc('hour', ts) AS ts, min_by(price, (ts, id)) AS o, max(price) AS h, min(price) AS l, max_by(price, (ts, id)) AS c, count(*) AS v FROM ticks GROUP BY 1, 2)"


def _hours(spark, d):
    e = t.table(spark, d, "events")
    return b.hourly(e.select(F.col("event_type").alias("sym"), "ts", F.col("event_id").alias("id"), F.col("value").alias("price")))


@query(f"WITH {HOURS} SELECT * FROM hours")
def bars_hourly(spark, d):
    return _hours(spark, d)


@query(f"WITH {HOURS}, x AS (SELECT sym, CAST(ts AS DATE) AS d, min_by(o, ts) AS o, max(h) AS h, min(l) AS l, max_by(c, ts) AS c, CAST(sum(v) AS BIGINT) AS v, count(*) AS n_source_bars, count(DISTINCT hour(ts)) AS k FROM hours GROUP BY 1, 2) SELECT sym, d, o, h, l, c, v, n_source_bars FROM x WHERE n_source_bars = 24 AND k = 24")
def bars_hourly_to_daily(spark, d):
    return b.daily_from_hourly(_hours(spark, d))


@query(f"WITH {sql.BARS}, x AS (SELECT sym, max(d) AS last FROM bars GROUP BY sym) SELECT min(last) AS watermark, count(*) AS symbols FROM x")
def ingestion_watermark(spark, d):
    return t.watermark(t.bars_daily(spark, d))


_mean_px = lambda status: f"(SELECT p_brand AS sym, CAST(l_shipdate AS DATE) AS d, avg(l_extendedprice / nullif(l_quantity, 0)) AS c FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linestatus = '{status}' GROUP BY 1, 2)"


@query(f"WITH a AS {_mean_px('O')}, b AS {_mean_px('F')}, x AS (SELECT sym, abs(a.c - b.c) / ((a.c + b.c) / 2) AS off FROM a JOIN b USING (sym, d)) SELECT sym, count(*) AS n, count(CASE WHEN off > 0.05 THEN 1 END) AS n_off, round(max(off), 6) AS worst FROM x GROUP BY sym")
def source_parity(spark, d):
    """Open and finished lines as two sources of the same brands' prices."""
    x = t.table(spark, d, "lineitem").join(t.table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("sym")), F.col("l_partkey") == F.col("p_partkey"))
    of = lambda status: x.where(F.col("l_linestatus") == status).groupBy("sym", F.to_date("l_shipdate").alias("d")).agg(F.avg(F.try_divide("l_extendedprice", "l_quantity")).alias("c"))
    return rounded(b.parity(of("O"), of("F"), 0.05))


_row = " || '|' || ".join(["CAST(d AS VARCHAR)", *(f"CAST(CAST(round({c} * 1000) AS BIGINT) AS VARCHAR)" for c in "ohlcv")])


@query(f"WITH {sql.BARS} SELECT sym, count(*) AS n, sha256(string_agg({_row}, chr(10) ORDER BY d)) AS content_sha256 FROM bars GROUP BY sym")
def content_hash(spark, d):
    return b.content_hash(t.bars_daily(spark, d), 1000)


# ---- screening, coverage, stores
PERF = f"{sql.BARS}, x AS (SELECT sym, d, c, c / nullif(lag(c) OVER s, 0) - 1 AS r, max(c) OVER s AS top FROM bars WINDOW s AS (PARTITION BY sym ORDER BY d)), perf AS (SELECT sym, count(r) AS n, max_by(c, d) / min_by(c, d) - 1 AS total_return, stddev_samp(r) * sqrt(252) AS volatility, avg(r) * sqrt(252) / nullif(stddev_samp(r), 0) AS sharpe, min(c / top - 1) AS max_drawdown FROM x GROUP BY sym HAVING count(r) >= 20)"


@query(f"WITH {PERF} SELECT sym, n, round(total_return, 6) + 0.0 AS total_return, round(volatility, 6) AS volatility, round(sharpe, 6) + 0.0 AS sharpe, round(max_drawdown, 6) + 0.0 AS max_drawdown FROM perf")
def perf_stats(spark, d):
    return rounded(screen.performance(t.bars_daily(spark, d)))


@query(f"WITH {PERF}, l AS (SELECT list_sort(list(sharpe)) AS s, stddev_samp(sharpe) AS sd FROM perf) SELECT round(s[len(s) // 2 + 1], 6) + 0.0 AS median, round(sd, 6) AS sd, round(s[len(s) // 2 + 1] + 0.5 * sd, 6) + 0.0 AS add_above FROM l")
def screen_thresholds(spark, d):
    return rounded(screen.thresholds(screen.performance(t.bars_daily(spark, d))))


@query(f"WITH {PERF} SELECT sym, n, round(total_return, 6) + 0.0 AS total_return, round(volatility, 6) AS volatility, round(sharpe, 6) + 0.0 AS sharpe, round(max_drawdown, 6) + 0.0 AS max_drawdown FROM perf ORDER BY perf.sharpe DESC, sym LIMIT 5")
def screen_best(spark, d):
    return rounded(screen.best(screen.performance(t.bars_daily(spark, d)), 5))


OPTIONS = "opt AS (SELECT p_brand AS root, DATE '2024-01-01' + CAST(p_partkey % 90 AS INTEGER) AS expiry, CASE WHEN p_size % 2 = 0 THEN 'C' ELSE 'P' END AS kind, p_retailprice AS strike, p_size / 50.0::DOUBLE AS iv FROM part)"


@query(f"WITH {OPTIONS} SELECT root, kind, expiry, strike, iv FROM opt WHERE abs(date_diff('day', DATE '2024-01-01', expiry) - 30) <= 10 QUALIFY row_number() OVER (PARTITION BY root, kind ORDER BY abs(date_diff('day', DATE '2024-01-01', expiry) - 30), expiry, abs(strike - 1200), strike, iv) = 1")
def options_atm(spark, d):
    p = t.table(spark, d, "part")
    day = F.lit("2024-01-01").cast("date")
    x = p.select(F.col("p_brand").alias("root"), F.date_add(day, (F.col("p_partkey") % 90).cast("int")).alias("expiry"), F.when(F.col("p_size") % 2 == 0, "C").otherwise("P").alias("kind"), F.col("p_retailprice").alias("strike"), (F.col("p_size") / 50.0).alias("iv"))
    return screen.nearest_atm(x, day, F.lit(1200.0), 30)


@query("SELECT user_id AS sym, CAST(ts AS DATE) AS d, arg_max(value, event_id) AS value, max(event_id) AS seq FROM events GROUP BY 1, 2")
def upsert_keep_last(spark, d):
    """An old store, the events ingested up to the middle of the sequence, and all later ones on top of it."""
    e = t.table(spark, d, "events").select(F.col("user_id").alias("sym"), F.to_date("ts").alias("d"), "value", F.col("event_id").alias("seq"))
    middle = e.agg(F.expr("min(seq) + (max(seq) - min(seq)) div 2")).first()[0]
    old, new = (t.keep_last(e.where(side), ["sym", "d"], "seq") for side in (F.col("seq") <= F.lit(middle), F.col("seq") > F.lit(middle)))
    return t.upsert(old, new, ["sym", "d"])


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, coalesce(CAST(json_extract_string(props, '$.missing') AS BIGINT), 0) AS missing FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def parse_json_counts(spark, d):
    x = t.table(spark, d, "events").select("event_id", F.from_json("props", "k long, missing long").alias("j"))
    return x.where("j.k is not null").select("event_id", "j.k", F.coalesce("j.missing", F.lit(0)).cast("long").alias("missing"))


@query("SELECT n_name AS sym, round((2 * (n_nationkey % 5) + n_regionkey - 2 * (n_nationkey % 2)) / nullif(CAST(n_nationkey % 5 + n_regionkey + n_nationkey % 3 + n_nationkey % 2 AS DOUBLE), 0), 6) + 0.0 AS score FROM nation")
def consensus_score(spark, d):
    n = t.table(spark, d, "nation")
    k, r = F.col("n_nationkey"), F.col("n_regionkey")
    return rounded(n.select(F.col("n_name").alias("sym"), scalars.consensus(k % 5, r, k % 3, F.lit(0), k % 2).alias("score")))


@query("WITH x AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), a AS (SELECT d, CAST(isodow(d) - 1 AS INTEGER) AS m FROM x), z AS (SELECT d, d - greatest(m - 4, 0) AS f FROM a) SELECT d, CAST(f + CAST(floor((least(m, 4) + 20) / 5.0) * 7 + (least(m, 4) + 20) % 5 - least(m, 4) AS INTEGER) AS DATE) AS ahead, CAST(f + CAST(floor((least(m, 4) - 3) / 5.0) * 7 + ((least(m, 4) - 3) % 5 + 5) % 5 - least(m, 4) AS INTEGER) AS DATE) AS back FROM z JOIN a USING (d)")
def business_days(spark, d):
    x = t.table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return x.select("d", scalars.business_days(F.col("d"), 20).alias("ahead"), scalars.business_days(F.col("d"), -3).alias("back"))


# ---- splits and revisions
@query(f"WITH {sql.BARS}, sp AS (SELECT sym, d, 2.0 AS ratio FROM bars WHERE day(d) = 1 AND month(d) % 6 = 1) SELECT b.sym, b.d, round(coalesce((SELECT product(sp.ratio) FROM sp WHERE sp.sym = b.sym AND sp.d > b.d), 1), 6) AS factor FROM bars b")
def split_factor_calendar(spark, d):
    bars = t.bars_daily(spark, d)
    sp = bars.where((F.dayofmonth("d") == 1) & (F.month("d") % 6 == 1)).select("sym", "d", F.lit(2.0).alias("ratio"))
    return rounded(splits.reconstructed(bars, sp))


@query()
def split_factor_measured(spark, d):
    bars = t.bars_daily(spark, d)
    factor = F.when(F.col("d") < F.lit("1995-01-01").cast("date"), 2.0).otherwise(1.0)
    sp = bars.select("sym").distinct().select("sym", F.lit("1995-01-01").cast("date").alias("d"), F.lit(2.0).alias("ratio"))
    return rounded(splits.measured(bars.select("sym", "d", (F.col("c") * factor).alias("raw"), F.col("c").alias("adjusted")), sp))


@query(f"WITH {sql.BARS}, x AS (SELECT sym, d, c, lag(c) OVER s AS a, lead(c) OVER s AS z, CASE WHEN count(c) OVER m >= 3 THEN quantile_cont(c, 0.5) OVER m END AS mid FROM bars WINDOW s AS (PARTITION BY sym ORDER BY d), m AS (PARTITION BY sym ORDER BY d ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)) SELECT sym, d, coalesce(c > 1.5 * a AND c > 1.5 * z, FALSE) AS spike, coalesce(c > 20 * mid OR c < mid / 20, FALSE) AS gross FROM x")
def share_outliers(spark, d):
    spike, gross = splits.outliers("c")
    return t.bars_daily(spark, d).select("sym", "d", spike.alias("spike"), gross.alias("gross"))


SNAPS = "snaps AS (SELECT c_nationkey AS sym, CAST(date_trunc('month', o_orderdate) AS DATE) AS as_of, make_date(CAST(year(o_orderdate) AS INTEGER) + CAST(o_orderkey % 2 AS INTEGER), 12, 31) AS fiscal_end, max(o_totalprice) AS eps FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3)"


def _snaps(spark, d):
    o = t.table(spark, d, "orders").join(t.table(spark, d, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    end = F.make_date((F.year("o_orderdate") + F.col("o_orderkey") % 2).cast("int"), F.lit(12), F.lit(31))
    return o.groupBy(F.col("c_nationkey").alias("sym"), F.date_trunc("month", "o_orderdate").cast("date").alias("as_of"), end.alias("fiscal_end")).agg(F.max("o_totalprice").alias("eps"))


@query(f"""WITH {SNAPS}, f AS (SELECT sym, as_of, min(fiscal_end) AS fiscal_end FROM snaps WHERE fiscal_end >= as_of GROUP BY 1, 2),
mv AS (SELECT sym, fiscal_end, as_of, eps, sum(CASE WHEN eps > p THEN 1 ELSE 0 END) OVER w AS u, sum(CASE WHEN eps < p THEN 1 ELSE 0 END) OVER w AS v FROM (SELECT *, lag(eps) OVER (PARTITION BY sym, fiscal_end ORDER BY as_of) AS p FROM snaps) WINDOW w AS (PARTITION BY sym, fiscal_end ORDER BY as_of)),
a AS (SELECT DISTINCT sym, as_of, CAST(isodow(as_of) - 1 AS INTEGER) AS m FROM snaps), z AS (SELECT sym, as_of, CAST(as_of - greatest(m - 4, 0) + CAST(floor((least(m, 4) - 20) / 5.0) * 7 + ((least(m, 4) - 20) % 5 + 5) % 5 - least(m, 4) AS INTEGER) AS DATE) AS then,
  CAST(as_of - greatest(m - 4, 0) + CAST(floor((least(m, 4) + 1) / 5.0) * 7 + (least(m, 4) + 1) % 5 - least(m, 4) AS INTEGER) AS DATE) AS usable_from FROM a),
j AS (SELECT z.sym, z.as_of, z.usable_from, max(s.as_of) AS lag_snap FROM z LEFT JOIN (SELECT DISTINCT sym, as_of FROM snaps) s ON s.sym = z.sym AND s.as_of <= z.then GROUP BY 1, 2, 3),
k AS (SELECT j.*, f.fiscal_end, n.eps, o.eps AS eps_lag, CAST(n.u - o.u AS BIGINT) AS n_up, CAST(n.v - o.v AS BIGINT) AS n_down FROM j LEFT JOIN f ON f.sym = j.sym AND f.as_of = j.as_of LEFT JOIN mv n ON n.sym = j.sym AND n.as_of = j.as_of AND n.fiscal_end = f.fiscal_end LEFT JOIN mv o ON o.sym = j.sym AND o.as_of = j.lag_snap AND o.fiscal_end = f.fiscal_end)
SELECT sym, as_of, fiscal_end, eps, eps_lag, round((eps - eps_lag) / nullif(abs(eps_lag), 0), 6) + 0.0 AS eps_drift, n_up, n_down, round((n_up - n_down) / nullif(n_up + n_down, 0)::DOUBLE, 6) + 0.0 AS breadth,
  CASE WHEN fiscal_end IS NULL THEN 'no_fy1' WHEN lag_snap IS NULL THEN 'no_lag_snapshot' WHEN eps_lag IS NULL THEN 'no_fy1_row_at_lag' WHEN eps_lag = 0 THEN 'zero_denominator' WHEN n_up + n_down = 0 THEN 'no_update_in_window' END AS reason, usable_from FROM k""")
def estimate_revisions(spark, d):
    return rounded(revisions.revisions(_snaps(spark, d)))


# ---- stores and lags
@query("SELECT sym, d, price, seq FROM (SELECT o_custkey AS sym, CAST(o_orderdate AS DATE) AS d, o_totalprice AS price, o_orderkey AS seq FROM orders) WHERE d BETWEEN DATE '1995-02-01' AND DATE '1996-03-31' QUALIFY row_number() OVER (PARTITION BY sym, d ORDER BY seq DESC, price DESC) = 1")
def load_range(spark, d):
    o = t.table(spark, d, "orders").select(F.col("o_custkey").alias("sym"), F.to_date("o_orderdate").alias("d"), F.col("o_totalprice").alias("price"), F.col("o_orderkey").alias("seq"))
    return t.load_range(o, "1995-02-01", "1996-03-31")


@query(f"WITH {sql.BARS} SELECT sym, min(d) AS first, max(d) AS last, min(d) <= DATE '1992-01-10' AND max(d) >= DATE '1998-11-25' AS fresh FROM bars GROUP BY sym")
def stored_range(spark, d):
    return t.freshness(t.bars_daily(spark, d), "1992-01-10", "1998-11-25")


@query(f"WITH {sql.BARS}, cal AS (SELECT sym, d FROM bars), rel AS (SELECT sym, d, c AS x FROM bars WHERE day(d) <= 7), j AS (SELECT c.sym, c.d, r.x FROM cal c ASOF LEFT JOIN rel r ON r.sym = c.sym AND c.d >= r.d) SELECT sym, d, round(lag(x, 3) OVER (PARTITION BY sym ORDER BY d), 8) AS x FROM j")
def release_lag(spark, d):
    """Closes of each month's first week as releases, on all bar days, three rows later."""
    bars = t.bars_daily(spark, d)
    x = factors.lagged_onto(bars.select("sym", "d"), bars.where(F.dayofmonth("d") <= 7).select("sym", "d", F.col("c").alias("x")), 3)
    return x.withColumn("x", F.round("x", 8))


@query(f"WITH {FACTS} SELECT sym, period_end, {_listed}, available, 'filed' AS source FROM wide WHERE {' + '.join(f'CASE WHEN {c} IS NULL THEN 0 ELSE 1 END' for c in CONCEPTS)} >= 0.6 * {len(CONCEPTS)}")
def row_coverage(spark, d):
    return screen.row_coverage(_wide(spark, d), CONCEPTS, 0.6)


@query("WITH u AS (SELECT DISTINCT c_custkey AS sym FROM customer), s AS (SELECT 'orders' AS source, o_custkey AS sym, max(CAST(o_orderdate AS DATE)) AS last FROM orders GROUP BY ALL UNION ALL SELECT 'events', user_id, max(CAST(ts AS DATE)) FROM events GROUP BY ALL) SELECT source, count(*) AS n, round(count(*) / (SELECT count(*) FROM u)::DOUBLE, 6) AS share, max(last) AS last FROM s JOIN u USING (sym) GROUP BY source")
def source_coverage(spark, d):
    o = t.table(spark, d, "orders").select(F.col("o_custkey").alias("sym"), F.to_date("o_orderdate").alias("d"))
    e = t.table(spark, d, "events").select(F.col("user_id").alias("sym"), F.to_date("ts").alias("d"))
    return rounded(screen.source_coverage(t.table(spark, d, "customer").select(F.col("c_custkey").alias("sym")), orders=o, events=e))


@query("SELECT event_type AS sym, date_trunc('hour', ts) + INTERVAL 1 HOUR AS bar_close, count(*) AS n FROM events WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= TIMESTAMP '2024-01-20' GROUP BY ALL")
def eligible_bars(spark, d):
    """Hour bars that have closed by a session's midnight, that midnight included."""
    x = t.table(spark, d, "events").groupBy(F.col("event_type").alias("sym"), (F.date_trunc("hour", "ts") + F.expr("INTERVAL 1 HOUR")).alias("bar_close")).agg(F.count("*").alias("n"))
    return b.eligible(x, "2024-01-20")
