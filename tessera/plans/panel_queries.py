"""Registered queries, third part: panels, their guards, coverage and fetch reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import windows as w
from tessera.operators import panels
from tessera.plans import sql
from tessera.plans.queries import query, rounded
from tessera.sources import parsers
from tessera.sources import tables as t

FEATURES = ["kmid", "klen", "roc5"]
PANEL = f"""{sql.BARS}, f AS (SELECT sym, d, c, v, (c - o) / nullif(o, 0) AS kmid, (h - l) / nullif(o, 0) AS klen, lag(c, 5) OVER s / nullif(c, 0) AS roc5, lead(c, 1) OVER s / nullif(c, 0) - 1 AS fwd_1d, lead(c, 5) OVER s / nullif(c, 0) - 1 AS fwd_5d FROM bars WINDOW s AS (PARTITION BY sym ORDER BY d)),
p AS (SELECT *, CASE WHEN year(d) < 1996 THEN 'train' WHEN year(d) < 1998 THEN 'valid' ELSE 'test' END AS split FROM f WHERE fwd_1d IS NOT NULL AND fwd_5d IS NOT NULL)"""


def _panel(spark, d):
    """Features, labels and splits; the days of 1998 and later have no split of their own."""
    bars = t.bars_daily(spark, d)
    ratio = lambda a, b: F.try_divide(F.col(a) - F.col(b), "o")
    features = bars.select("sym", "d", ratio("c", "o").alias("kmid"), ratio("h", "l").alias("klen"), F.try_divide(w.lag("c", 5), "c").alias("roc5"))
    labels = bars.select("sym", "d", *((F.try_divide(w.lead("c", n), "c") - 1).alias(f"fwd_{n}d") for n in (1, 5)))
    splits = bars.where(F.year("d") < 1998).select("sym", "d", F.when(F.year("d") < 1996, "train").otherwise("valid").alias("split"))
    return panels.split_labels(panels.labelled(features, labels, ["fwd_1d", "fwd_5d"]), splits)


def _prices(df, price: str):
    """Rounded to six digits, prices to eight: as quotients of cents and small numbers they end at half of the sixth."""
    return df.select(*((F.round(c, 8 if c == price else 6) + 0.0).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes))


_each = lambda form: ", ".join(form.format(c=c) for c in FEATURES)


@query(f"""WITH {PANEL}, q AS (SELECT {_each("quantile_cont({c}, 0.001) AS lo_{c}, quantile_cont({c}, 0.999) AS hi_{c}")} FROM p WHERE split = 'train'),
k AS (SELECT sym, d, c, v, fwd_1d, fwd_5d, split, {_each("CASE WHEN hi_{c} > lo_{c} AND {c} IS NOT NULL THEN least(greatest({c}, lo_{c}), hi_{c}) ELSE {c} END AS {c}")} FROM p, q),
s AS (SELECT {_each("avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}")} FROM k WHERE split = 'train')
SELECT sym, d, {_each("round(least(greatest(coalesce(({c} - m_{c}) / CASE WHEN s_{c} > 1e-9 THEN s_{c} ELSE 1 END, 0), -5), 5), 6) + 0.0 AS {c}")}, round(fwd_1d, 6) + 0.0 AS fwd_1d, round(fwd_5d, 6) + 0.0 AS fwd_5d, split, round(c, 8) AS close, round(v, 6) AS volume FROM k, s""")
def equity_panel(spark, d):
    raw = t.bars_daily(spark, d).select("sym", "d", F.col("c").alias("close"), F.col("v").alias("volume"))
    return _prices(panels.attach(panels.train_standardised(_panel(spark, d), FEATURES), raw, ["sym", "d"]), "close")


@query(f"WITH {PANEL}, n AS (SELECT {_each('count({c}) AS {c}')} FROM p WHERE split = 'train') SELECT feature, n, n >= 252 AS enough FROM (UNPIVOT n ON {', '.join(FEATURES)} INTO NAME feature VALUE n)")
def train_history(spark, d):
    return panels.train_history(_panel(spark, d), FEATURES)


REPORTS = "rep AS (SELECT p_brand AS sym, CAST(date_trunc('quarter', l_shipdate) + INTERVAL 3 MONTH AS DATE) AS d, sum(l_quantity) AS shares, sum(l_extendedprice * l_discount) AS earnings, sum(l_extendedprice) AS book FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"


def _reports(spark, d):
    """What a brand sold in a quarter stands for its report, known from the first day of the next quarter."""
    x = t.table(spark, d, "lineitem").join(t.table(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    day = F.add_months(F.date_trunc("quarter", "l_shipdate").cast("date"), 3).alias("d")
    return x.groupBy(F.col("p_brand").alias("sym"), day).agg(F.sum("l_quantity").alias("shares"), F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("earnings"), F.sum("l_extendedprice").alias("book"))


@query(f"WITH {sql.BARS}, {REPORTS}, x AS (SELECT b.sym, b.d, r.shares * b.c AS cap, earnings, book FROM bars b ASOF LEFT JOIN rep r ON b.sym = r.sym AND b.d >= r.d WHERE b.sym IN (SELECT sym FROM rep)) SELECT sym, d, round(ln(cap), 8) + 0.0 AS log_market_cap, round(CASE WHEN cap > 0 THEN earnings / cap END, 8) + 0.0 AS earnings_yield, round(CASE WHEN cap > 0 THEN book / cap END, 8) + 0.0 AS book_to_price FROM x")
def daily_ratios(spark, d):
    x = panels.daily_ratios(t.bars_daily(spark, d), _reports(spark, d))
    x = x.withColumn("log_market_cap", F.ln("market_cap"))
    return x.select("sym", "d", *((F.round(c, 8) + 0.0).alias(c) for c in ("log_market_cap", "earnings_yield", "book_to_price")))


@query(f"WITH {REPORTS} SELECT sym, d, round(earnings / nullif(lag(earnings, 4) OVER s, 0) - 1, 6) + 0.0 AS growth, round(CASE WHEN shares > 0 THEN 1 / shares END, 9) + 0.0 AS per_share FROM rep WINDOW s AS (PARTITION BY sym ORDER BY d)")
def year_on_year(spark, d):
    x = _reports(spark, d).select("sym", "d", panels.year_on_year(F.col("earnings")).alias("growth"), panels.inverse(F.col("shares")).alias("per_share"))
    return x.select("sym", "d", (F.round("growth", 6) + 0.0).alias("growth"), (F.round("per_share", 9) + 0.0).alias("per_share"))


@query(f"WITH {sql.BARS}, a AS (SELECT sym, min(d) AS a, max(d) AS z FROM bars GROUP BY sym), days AS (SELECT sym, CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS d FROM a) SELECT sym, d, round(last_value(c IGNORE NULLS) OVER w, 8) AS c, round(last_value(v IGNORE NULLS) OVER w, 6) AS v FROM days LEFT JOIN bars USING (sym, d) WINDOW w AS (PARTITION BY sym ORDER BY d ROWS 3 PRECEDING)")
def filled_calendar(spark, d):
    return _prices(panels.filled_calendar(t.bars_daily(spark, d), ["c", "v"], 3), "c")


@query(f"WITH {sql.BARS}, days AS (SELECT DISTINCT d FROM bars) SELECT sym, days.d FROM (SELECT DISTINCT sym FROM bars) s, days WHERE isodow(days.d) <= 5 AND NOT EXISTS (SELECT 1 FROM bars b WHERE b.sym = s.sym AND b.d = days.d)")
def missing_days(spark, d):
    """Weekdays on which some symbol has a bar and this one has none: days are exploded, a few thousand for each symbol."""
    bars = t.bars_daily(spark, d).select("sym", "d")
    days = bars.where(F.weekday("d") < 5).agg(F.collect_set("d").alias("days"))  # at most one for each day
    expected = bars.select("sym").distinct().join(F.broadcast(days), F.lit(True)).select("sym", F.explode("days").alias("d"))
    return panels.missing(expected, bars, ["sym", "d"])


OPTIONS = "opt AS (SELECT p_brand AS root, DATE '2024-01-01' + CAST(p_partkey % 90 AS INTEGER) AS expiry, CASE WHEN p_size % 2 = 0 THEN 'C' ELSE 'P' END AS kind, p_retailprice AS strike, p_size / 50.0::DOUBLE AS iv FROM part)"
_atm = lambda n: f"a{n} AS (SELECT root, kind, iv FROM opt WHERE iv > 0 AND abs(date_diff('day', DATE '2024-01-01', expiry) - {n}) <= 10 QUALIFY row_number() OVER (PARTITION BY root, kind ORDER BY abs(date_diff('day', DATE '2024-01-01', expiry) - {n}), expiry, abs(strike - 1200), strike, iv) = 1), w{n} AS (SELECT root, max(CASE WHEN kind = 'C' THEN iv END) AS call_{n}, max(CASE WHEN kind = 'P' THEN iv END) AS put_{n} FROM a{n} GROUP BY root)"


@query(f"WITH {OPTIONS}, {_atm(30)}, {_atm(60)} SELECT root, round(call_30, 6) AS call_30, round(put_30, 6) AS put_30, round(call_60, 6) AS call_60, round(put_60, 6) AS put_60, round(put_30 - call_30, 6) + 0.0 AS skew_30, round(coalesce((call_60 + put_60) / 2, call_60) - coalesce((call_30 + put_30) / 2, call_30), 6) + 0.0 AS term FROM w30 FULL JOIN w60 USING (root)")
def option_surface(spark, d):
    p, day = t.table(spark, d, "part"), F.lit("2024-01-01").cast("date")
    x = p.select(F.col("p_brand").alias("root"), F.date_add(day, (F.col("p_partkey") % 90).cast("int")).alias("expiry"), F.when(F.col("p_size") % 2 == 0, "C").otherwise("P").alias("kind"), F.col("p_retailprice").alias("strike"), (F.col("p_size") / 50.0).alias("iv"))
    return rounded(panels.option_surface(x, day, F.lit(1200.0)))


@query("""WITH f AS (SELECT c_custkey % 40 AS k, c_custkey % 7 AS n, run FROM customer, (VALUES (1), (2)) v(run)), s AS (SELECT run, CASE WHEN k = 0 THEN 'premium_restricted' WHEN run = 1 AND k IN (1, 2) THEN 'quota_error' WHEN run = 1 AND k = 3 THEN 'fetch_error' WHEN n = 0 THEN 'no_coverage' ELSE 'with_data' END AS status FROM f),
x AS (SELECT run, count(*) AS requested, count(CASE status WHEN 'with_data' THEN 1 END) AS with_data, count(CASE status WHEN 'no_coverage' THEN 1 END) AS no_coverage, count(CASE status WHEN 'premium_restricted' THEN 1 END) AS premium_restricted, count(CASE WHEN status IN ('quota_error', 'fetch_error') THEN 1 END) AS errors FROM s GROUP BY run),
y AS (SELECT *, round(100 * with_data / (requested - premium_restricted)::DOUBLE, 1) AS coverage_pct, round(100 * with_data / requested::DOUBLE, 1) AS active_coverage_pct FROM x)
SELECT *, errors = 0 AND coverage_pct >= 80 AS passes FROM y""")
def fetch_summary(spark, d):
    """Answers of a vendor for each customer in two runs; the second, a day later, has no errors left."""
    k = F.col("c_custkey") % 40
    message = F.when(k == 2, "Rate limit: too many requests").when(k == 3, "no route to host")
    rows = F.when(k > 1, F.col("c_custkey") % 7)
    first = parsers.fetch_status(F.when(k == 0, 402).when(k == 1, 429), message, rows)
    again = parsers.fetch_status(F.when(k == 0, 402), F.lit(None).cast("string"), F.col("c_custkey") % 7)
    runs = [parsers.fetch_summary(t.table(spark, d, "customer").select(x.alias("status")), 80).withColumn("run", F.lit(n)) for n, x in ((1, first), (2, again))]
    return runs[0].unionByName(runs[1])


@query("WITH x AS (SELECT upper(event_type) AS sym, date_trunc('hour', ts) AS created_at, CAST(user_id % 10 AS VARCHAR) AS headline, event_id AS id, value, CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END AS new FROM events) SELECT sym, created_at, headline, id, value FROM x QUALIFY row_number() OVER (PARTITION BY sym, created_at, headline ORDER BY new, id) = 1")
def merged_news(spark, d):
    """Two overlapping stores: a third of the events, in lower case, came first."""
    e = t.table(spark, d, "events").select(F.col("event_type").alias("sym"), F.date_trunc("hour", "ts").alias("created_at"), (F.col("user_id") % 10).cast("string").alias("headline"), F.col("event_id").alias("id"), "value")
    return parsers.merged_news(e.where("id % 3 = 0"), e.where("id % 3 <> 0").withColumn("sym", F.upper("sym")))


@query("WITH c AS (SELECT DISTINCT p_brand AS concept, CAST(replace(p_brand, 'Brand#', '') AS BIGINT) % 2 = 0 AS instant FROM part), y AS (SELECT min(year(o_orderdate)) AS a, max(year(o_orderdate)) AS z FROM orders) SELECT concept, 'CY' || y || 'Q' || q || CASE WHEN instant THEN 'I' ELSE '' END AS period FROM c, (SELECT unnest(range(a, z + 1)) AS y FROM y), range(1, 5) b(q)")
def fetch_plan(spark, d):
    """A request for each brand and quarter of the years in which anything was ordered."""
    concepts = t.table(spark, d, "part").select(F.col("p_brand").alias("concept"), (F.regexp_replace("p_brand", "Brand#", "").cast("long") % 2 == 0).alias("instant")).distinct()
    return parsers.fetch_plan(concepts, t.table(spark, d, "orders").agg(F.min(F.year("o_orderdate")).alias("a"), F.max(F.year("o_orderdate")).alias("z")))


@query("SELECT sha256(string_agg(s, ',' ORDER BY s)) AS universe_sha256, count(*) AS n FROM (SELECT DISTINCT upper(trim(p_brand)) AS s FROM part)")
def universe_hash(spark, d):
    return panels.universe_hash(t.table(spark, d, "part").select(F.col("p_brand").alias("sym")))


@query("SELECT max(CAST(l_shipdate AS DATE)) AS last, count(CASE WHEN CAST(l_shipdate AS DATE) > DATE '1998-06-30' THEN 1 END) AS n_future FROM lineitem")
def future_rows(spark, d):
    return panels.future_rows(t.table(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("d")), F.lit("1998-06-30").cast("date"))
