"""Registered queries, seventh part: ingestion, harvests, hash trees, manifests and the seam to a vendor."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import bars as b
from tessera.operators import ingest, integrity
from tessera.plans import sql
from tessera.plans.queries import query
from tessera.sources import seam
from tessera.sources import tables as t

# ---- what is still to be fetched
STORED = "stored AS (SELECT sym, d FROM bars WHERE sym NOT IN ('Brand#3', 'Brand#4') AND d < DATE '1998-06-01' + CAST(CAST(replace(sym, 'Brand#', '') AS BIGINT) % 5 AS INTEGER))"


@query(f"WITH {sql.BARS}, {STORED}, x AS (SELECT DISTINCT p_brand AS sym FROM part), l AS (SELECT x.sym, max(d) AS last FROM x LEFT JOIN stored USING (sym) GROUP BY x.sym) SELECT sym, coalesce(last + 1, DATE '1998-06-10' - 3650) AS start, DATE '1998-06-10' AS \"end\", last FROM l WHERE last IS NULL OR last < DATE '1998-06-04'")
def ingest_windows(spark, d):
    """Delta windows of all brands: some stores are fresh, some stale, two are cold."""
    n = F.regexp_replace("sym", "Brand#", "").cast("int")
    stored = t.bars_daily(spark, d).select("sym", "d").where(~F.col("sym").isin("Brand#3", "Brand#4") & (F.col("d") < F.date_add(F.lit("1998-06-01").cast("date"), n % 5)))
    day = lambda x: F.lit(x).cast("date")
    return ingest.windows(t.table(spark, d, "part").select(F.col("p_brand").alias("sym")), stored, day("1998-06-10"), day("1998-06-04"))


LIMIT = 300
CHUNKS = f"""WITH RECURSIVE e AS (SELECT event_type AS sym, CAST(ts AS DATE) AS d FROM events), r AS (SELECT sym, min(d) AS a, max(d) AS z FROM e GROUP BY sym),
c AS (SELECT sym, a, z FROM r UNION ALL SELECT sym, CASE WHEN h = 0 THEN a ELSE a + CAST(floor(date_diff('day', a, z) / 2) AS INTEGER) + 1 END, CASE WHEN h = 0 THEN a + CAST(floor(date_diff('day', a, z) / 2) AS INTEGER) ELSE z END
  FROM c, (VALUES (0), (1)) v(h) WHERE date_diff('day', a, z) >= 1 AND (SELECT count(*) FROM e WHERE e.sym = c.sym AND e.d BETWEEN c.a AND c.z) >= {LIMIT}),
n AS (SELECT c.*, (SELECT count(*) FROM e WHERE e.sym = c.sym AND e.d BETWEEN c.a AND c.z) AS n FROM c)"""


@query(f"{CHUNKS} SELECT sym, a, z FROM n WHERE n < {LIMIT} OR a = z")
def chunk_plan(spark, d):
    """Ranges of days, halved until no answer reaches the limit (or a range is one day)."""
    e = t.table(spark, d, "events").select(F.col("event_type").alias("sym"), F.to_date("ts").alias("d"))
    per_day = e.groupBy("sym", "d").agg(F.count("*").alias("n"))

    def saturated(ranges):
        days = ranges.select("*", F.explode(F.sequence("a", "z")).alias("d"))
        return days.join(per_day, ["sym", "d"]).groupBy("sym", "a", "z").agg(F.sum("n").alias("n")).where(F.col("n") >= LIMIT)

    return ingest.chunks(e.groupBy("sym").agg(F.min("d").alias("a"), F.max("d").alias("z")), saturated)


# ---- what a run has sealed
THROUGH = "2024-01-25 06:00:00"
RUN = f"""tick AS (SELECT event_type AS sym, ts, event_id AS id, value AS p FROM events), named AS (SELECT *, CASE WHEN sym = 'purchase' THEN ts + INTERVAL 40 DAY ELSE ts END AS t FROM tick),
hr AS (SELECT sym, date_trunc('hour', t) AS ts, min_by(p, (t, id)) AS o, max(p) AS h, min(p) AS l, max_by(p, (t, id)) AS c, count(*) AS v FROM named GROUP BY 1, 2),
dy AS (SELECT sym, CAST(ts AS DATE) + CASE WHEN sym = 'error' THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END AS ts, min_by(o, hr.ts) AS o, max(h) AS h, min(l) AS l, max_by(c, hr.ts) AS c, CAST(sum(v) AS BIGINT) AS v FROM hr WHERE sym <> 'signup' GROUP BY sym, CAST(ts AS DATE)),
whole AS (SELECT sym, CAST(ts AS DATE) AS d, min_by(o, ts) AS o, max(h) AS h, min(l) AS l, max_by(c, ts) AS c, CAST(sum(v) AS BIGINT) AS v FROM hr GROUP BY 1, 2 HAVING count(*) = 24 AND count(DISTINCT hour(ts)) = 24),
kept AS (SELECT sym, CAST(ts AS DATE) AS d, o, h, l, c, v, 'daily' AS source FROM dy WHERE sym NOT IN (SELECT sym FROM dy WHERE ts <> date_trunc('day', ts)) AND CAST(ts AS DATE) + 1 <= TIMESTAMP '{THROUGH}'
  UNION ALL SELECT *, 'hourly' FROM whole WHERE sym IN (SELECT sym FROM dy WHERE ts <> date_trunc('day', ts)) AND d + 1 <= TIMESTAMP '{THROUGH}'),
old AS (SELECT sym, d - 10 AS d, o, h, l, c, v FROM whole WHERE sym <> 'purchase'), held AS (SELECT sym, d, o, h, l, c, v FROM kept UNION ALL SELECT * FROM old o WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.sym = o.sym AND k.d = o.d)),
uni AS (SELECT DISTINCT sym FROM tick UNION ALL SELECT 'refund')"""


def _hash_tree(rows: str, scale: int) -> str:
    """Named subqueries of a hash tree over (sym, d, o, h, l, c, v)."""
    text = " || '|' || ".join(["CAST(d AS VARCHAR)", *(f"coalesce(CAST(CAST(round({c} * {scale}) AS BIGINT) AS VARCHAR), '')" for c in "ohlcv")])
    return f"""lf AS (SELECT sym, CAST(date_trunc('month', d) AS DATE) AS leaf, count(*) AS n, sha256(string_agg(r, chr(10) ORDER BY r)) AS leaf_sha256 FROM (SELECT sym, d, sha256({text}) AS r FROM {rows}) GROUP BY 1, 2),
tr AS (SELECT sym, sha256(string_agg(leaf || '=' || leaf_sha256, chr(10) ORDER BY leaf || '=' || leaf_sha256)) AS content_sha256, CAST(sum(n) AS BIGINT) AS n FROM lf GROUP BY sym)"""


def _root(rows: str) -> str:
    return f"(SELECT sha256(string_agg(b || '=' || h, chr(10) ORDER BY b || '=' || h)) FROM (SELECT substr(sha256(x), 1, 2) AS b, sha256(string_agg(x, chr(10) ORDER BY x)) AS h FROM ({rows}) GROUP BY 1))"


REPORT = f"""{RUN}, {_hash_tree('held', 1_000_000)},
k AS (SELECT sym, count(*) AS rows_ingested, max(source) AS source FROM kept GROUP BY sym), g AS (SELECT sym, count(*) AS rows_total, min(d) AS first_bar, max(d) AS last_bar, CAST(max(d) + 1 AS TIMESTAMP) AS last_bar_close FROM held GROUP BY sym),
rep AS (SELECT u.sym, s.status, CASE WHEN s.status = 'ok' THEN k.rows_ingested ELSE 0 END AS rows_ingested, CASE WHEN s.status = 'ok' THEN source END AS source, CASE WHEN s.status = 'ok' THEN rows_total END AS rows_total, CASE WHEN s.status = 'ok' THEN first_bar END AS first_bar, CASE WHEN s.status = 'ok' THEN last_bar END AS last_bar, CASE WHEN s.status = 'ok' THEN last_bar_close END AS last_bar_close, CASE WHEN s.status = 'ok' THEN content_sha256 END AS content_sha256
  FROM uni u LEFT JOIN k USING (sym) LEFT JOIN g USING (sym) LEFT JOIN tr USING (sym), LATERAL (SELECT CASE WHEN u.sym NOT IN (SELECT sym FROM dy) THEN 'no_data' WHEN k.rows_ingested IS NULL THEN 'no_sealed_bars' ELSE 'ok' END AS status) s)"""


def _run(spark, d):
    """Events as ticks: one symbol's daily bars open an hour late, one has no daily bars, one's have not closed, one was never seen."""
    e = t.table(spark, d, "events")
    ts = F.when(F.col("event_type") == "purchase", F.col("ts") + F.expr("INTERVAL 40 DAYS")).otherwise(F.col("ts"))
    hours = b.hourly(e.select(F.col("event_type").alias("sym"), ts.alias("ts"), F.col("event_id").alias("id"), F.col("value").alias("price")))
    g = hours.where("sym <> 'signup'").groupBy("sym", F.to_date("ts").alias("d")).agg(F.min(F.struct("ts", "o")).alias("f"), F.max("h").alias("h"), F.min("l").alias("l"), F.max(F.struct("ts", "c")).alias("x"), F.sum("v").alias("v"))
    shift = F.when(F.col("sym") == "error", F.expr("INTERVAL 1 HOUR")).otherwise(F.expr("INTERVAL 0 HOUR"))
    daily = g.select("sym", (F.col("d").cast("timestamp") + shift).alias("ts"), F.col("f.o").alias("o"), "h", "l", F.col("x.c").alias("c"), "v")
    kept = ingest.sealed_daily(daily, hours, THROUGH)
    old = b.daily_from_hourly(hours.where("sym <> 'purchase'")).select("sym", F.date_sub("d", 10).alias("d"), *"ohlcv").withColumn("bar_close", F.date_add("d", 1).cast("timestamp"))
    held = t.upsert(old, kept.drop("source"), ["sym", "d"])
    universe = e.select(F.col("event_type").alias("sym")).distinct().union(spark.createDataFrame([("refund",)], "sym string"))
    return universe, daily, kept, held


def _report(spark, d):
    return ingest.report(*_run(spark, d))


@query(f"WITH {REPORT} SELECT * FROM rep")
def ingest_report(spark, d):
    return _report(spark, d)


@query(f"""WITH {REPORT} SELECT min(CASE WHEN status = 'ok' THEN last_bar_close END) AS watermark, count(*) AS n_expected, count(CASE WHEN status = 'ok' THEN 1 END) AS n_ok,
  {_root("SELECT sym || '=' || sha256(sym) AS x FROM rep")} AS expected_universe_hash, {_root("SELECT sym || '=' || content_sha256 AS x FROM rep WHERE status = 'ok'")} AS symbols_hash,
  'daily' AS dataset_id, TIMESTAMP '2024-01-25 06:05:00' AS generated_at, TIMESTAMP '{THROUGH}' AS fetched_through, count(*) = count(CASE WHEN status = 'ok' THEN 1 END) AS universe_complete, count(*) = count(CASE WHEN status = 'ok' THEN 1 END) AS signal_eligible FROM rep""")
def ingest_manifest(spark, d):
    """The run's seal without its fingerprint, which is over JSON that another engine spells differently."""
    return ingest.manifest(_report(spark, d), "daily", "2024-01-25 06:05:00", THROUGH).drop("fingerprint")


@query(f"WITH {sql.BARS}, {_hash_tree('bars', 1000)} SELECT sym, content_sha256, n FROM tr")
def content_tree(spark, d):
    return integrity.tree(t.bars_daily(spark, d), ["sym"], F.date_trunc("month", "d"), "d", list("ohlcv"), 1000)


_touched = "(SELECT sym, d, o, h, l, CASE WHEN sym = 'Brand#2' AND year(d) = 1995 AND month(d) = 3 THEN c + 1 ELSE c END AS c, v FROM bars WHERE NOT (sym = 'Brand#5' AND year(d) = 1996 AND month(d) = 2))"


@query(f"WITH {sql.BARS}, {_hash_tree('(SELECT * FROM bars WHERE NOT (sym = ' + repr('Brand#9') + ' AND year(d) = 1997 AND month(d) = 1))', 1000).replace('lf AS', 'l1 AS').replace('FROM lf', 'FROM l1').replace('tr AS', 't1 AS')}, {_hash_tree(_touched, 1000)} SELECT sym, leaf, CASE WHEN lf.leaf_sha256 IS NULL THEN 'missing' WHEN l1.leaf_sha256 IS NULL THEN 'not sealed' ELSE 'changed' END AS problem FROM l1 FULL JOIN lf USING (sym, leaf) WHERE l1.leaf_sha256 IS DISTINCT FROM lf.leaf_sha256")
def changed_leaves(spark, d):
    """The closes of one month were altered, one month is gone, one was never sealed: the tree names just these leaves."""
    bars = t.bars_daily(spark, d)
    month = lambda sym, y, m: (F.col("sym") == sym) & (F.year("d") == y) & (F.month("d") == m)
    close = F.when(month("Brand#2", 1995, 3), F.col("c") + 1).otherwise(F.col("c"))
    of = lambda df: integrity.leaves(df, ["sym"], F.date_trunc("month", "d"), "d", list("ohlcv"), 1000)
    return integrity.changed(of(bars.where(~month("Brand#9", 1997, 1))), of(bars.where(~month("Brand#5", 1996, 2)).withColumn("c", close)), ["sym"])


@query(f"WITH {REPORT} SELECT sym, 'universe incomplete' AS problem FROM rep")
def signal_problems_partial(spark, d):
    """The run lacks symbols, so no bars of it may back a signal, however good they are."""
    rep = _report(spark, d)
    m = ingest.manifest(rep, "daily", "2024-01-25 00:05:00", THROUGH)
    return integrity.signal_problems(m, rep, rep.select("sym", "content_sha256"), "2024-01-25 00:00:00")


@query(f"WITH {REPORT} SELECT sym, CASE WHEN sym = 'click' THEN 'content differs from the sealed one' END AS problem FROM rep WHERE status = 'ok' AND last_bar = DATE '2024-01-24'")
def signal_problems(spark, d):
    """The symbols that reach the session are their own universe; one's stored bars were altered after the seal."""
    rep = _report(spark, d).where("status = 'ok' and last_bar = date '2024-01-24'")
    m = ingest.manifest(rep, "daily", "2024-01-25 00:05:00", THROUGH)
    actual = rep.select("sym", F.when(F.col("sym") == "click", F.sha2("content_sha256", 256)).otherwise(F.col("content_sha256")).alias("content_sha256"))
    return integrity.signal_problems(m, rep, actual, "2024-01-25 00:00:00")


# ---- harvests and bundles
HARVEST = "h AS (SELECT 'C' || o_custkey % 200 AS sym, FALSE AS done, NULL AS n_records FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT 'C' || k, TRUE, (SELECT count(*) FROM orders WHERE o_orderkey % 3 = 0 AND o_custkey % 200 = k) + CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END FROM range(200) r(k) WHERE k % 4 <> 0)"


@query(f"WITH {HARVEST}, d AS (SELECT sym FROM h GROUP BY sym HAVING max(CASE WHEN done THEN n_records END) = count(CASE WHEN NOT done THEN 1 END)) SELECT DISTINCT 'C' || c_custkey % 250 AS sym FROM customer WHERE 'C' || c_custkey % 250 NOT IN (FROM d)")
def open_harvest(spark, d):
    """Symbols without a marker, or whose marker states other records than are there, and those never begun."""
    o = t.table(spark, d, "orders").where("o_orderkey % 3 = 0").select((F.col("o_custkey") % 200).alias("k"))
    rows = o.select(F.concat(F.lit("C"), "k").alias("sym"), F.lit(False).alias("done"), F.lit(None).cast("long").alias("n_records"))
    marks = spark.range(200).where("id % 4 <> 0").join(o.groupBy("k").agg(F.count("*").alias("n")), F.col("id") == F.col("k"), "left")
    marks = marks.select(F.concat(F.lit("C"), "id").alias("sym"), F.lit(True).alias("done"), (F.coalesce("n", F.lit(0)) + F.when(F.col("id") % 7 == 0, 1).otherwise(0)).alias("n_records"))
    return ingest.open_symbols(t.table(spark, d, "customer").select(F.concat(F.lit("C"), F.col("c_custkey") % 250).alias("sym")), rows.unionByName(marks))


@query("SELECT 'C' || o_custkey AS sym, CAST(date_trunc('month', o_orderdate) AS DATE)::VARCHAR AS month, count(*) AS n FROM orders WHERE year(o_orderdate) <> 1994 GROUP BY ALL")
def missing_months(spark, d):
    """Grades by month, without the months of 1994, which are there already."""
    o = t.table(spark, d, "orders").select(F.concat(F.lit("C"), "o_custkey").alias("sym"), F.to_date("o_orderdate").alias("d"))
    return ingest.missing_months(o, "d", [f"1994-{m:02d}-01" for m in range(1, 13)]).groupBy("sym", "month").agg(F.count("*").alias("n"))


_p = "'/' || p_brand"
BUNDLE = """stated AS (SELECT p_brand AS name, '/' || p_brand || CASE WHEN min(p_partkey) % 7 = 0 THEN '?' ELSE '' END AS template, sha256(p_brand) AS sha256, sha256(p_brand || CASE WHEN min(p_partkey) % 5 = 0 THEN 'x' ELSE '' END) AS child_sha256, CASE WHEN min(p_partkey) % 6 = 1 THEN 'partial' ELSE 'ok' END AS status, (min(p_partkey) % 10) / 10.0 AS coverage, CASE WHEN min(p_partkey) % 8 = 3 THEN ['symbol'] ELSE ['symbol', 'fiscal_date'] END AS columns FROM part WHERE p_brand <> 'Brand#1' GROUP BY p_brand),
found AS (SELECT p_brand AS name, sha256(p_brand || CASE WHEN min(p_partkey) % 9 = 2 THEN 'y' ELSE '' END) AS sha256 FROM part WHERE p_brand <> 'Brand#6' GROUP BY p_brand), needed AS (SELECT DISTINCT p_brand AS name, '/' || p_brand AS template FROM part WHERE p_brand <> 'Brand#8')"""
_checks = [
    ("n.name IS NOT NULL AND s.name IS NULL", "the bundle lacks it"), ("n.name IS NULL", "nobody asked for it"), ("n.name IS NOT NULL AND s.template <> n.template", "it was fetched from elsewhere"), ("n.name IS NOT NULL AND s.name IS NOT NULL AND f.sha256 IS NULL", "its file is missing"),
    ("n.name IS NOT NULL AND (f.sha256 <> s.sha256 OR f.sha256 <> s.child_sha256)", "its file is not the one that was recorded"), ("n.name IS NOT NULL AND s.status <> 'ok'", "its status is not ok"), ("n.name IS NOT NULL AND s.coverage < 0.3", "its coverage is below the floor"), ("n.name IS NOT NULL AND len(s.columns) < 2", "it lacks a required column"),
]


@query(f"WITH {BUNDLE}, j AS (SELECT coalesce(n.name, s.name) AS name, {', '.join(f'({c}) AS c{k}' for k, (c, _) in enumerate(_checks))} FROM needed n FULL JOIN stated s ON s.name = n.name LEFT JOIN found f ON f.name = coalesce(n.name, s.name)) " + " UNION ALL ".join(f"SELECT name, '{text}' AS problem FROM j WHERE c{k}" for k, (_, text) in enumerate(_checks)))
def bundle_problems(spark, d):
    """A bundle of one file for each brand with every kind of fault."""
    g = t.table(spark, d, "part").groupBy(F.col("p_brand").alias("name")).agg(F.min("p_partkey").alias("k"))
    odd = lambda m, r, x: F.when(F.col("k") % m == r, x).otherwise("")
    columns = F.when(F.col("k") % 8 == 3, F.array(F.lit("symbol"))).otherwise(F.array(F.lit("symbol"), F.lit("fiscal_date")))
    stated = g.where("name <> 'Brand#1'").select("name", F.concat(F.lit("/"), "name", odd(7, 0, "?")).alias("template"), F.sha2("name", 256).alias("sha256"), F.sha2(F.concat("name", odd(5, 0, "x")), 256).alias("child_sha256"), F.when(F.col("k") % 6 == 1, "partial").otherwise("ok").alias("status"), (F.col("k") % 10 / 10.0).alias("coverage"), columns.alias("columns"))
    found = g.where("name <> 'Brand#6'").select("name", F.sha2(F.concat("name", odd(9, 2, "y")), 256).alias("sha256"))
    needed = g.where("name <> 'Brand#8'").select("name", F.concat(F.lit("/"), "name").alias("template"), F.array(F.lit("symbol"), F.lit("fiscal_date")).alias("columns"))
    return integrity.bundle_problems(stated, found, needed, 0.3)


@query("SELECT c_mktsegment AS sym, CAST(o_orderdate AS DATE) AS d, count(*) AS n, round(sum(o_totalprice), 2) AS value FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= DATE '1993-01-01' AND o_orderdate < DATE '1999-01-01' GROUP BY ALL")
def vendor_orders(spark, d):
    """Every segment's orders through the seam: thirty requests, read in parallel."""
    seam.register(spark)
    options = {"function": "tessera.sources.seam:trades", "schema": "sym string, d date, n long, value double", "names": "machinery,BUILDING,AUTOMOBILE, HOUSEHOLD,FURNITURE,BUILDING", "start": "1993-01-01", "end": "1998-12-31", "days": "366", "path": d}
    return spark.read.format("vendor").options(**options).load().withColumn("value", F.round("value", 2))
