"""Registered queries, fifth part: revision features from a lake of snapshots that orders stand for."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import snapshots
from tessera.plans.queries import query
from tessera.sources import tables as t

_ends = ", ".join(f"({k}, '{e}')" for k, e in enumerate(snapshots.ENDPOINTS))
#: Orders as snapshots: a hundred symbols; urgent orders are price targets, high ones grades, the others estimates of up to
#: three fiscal years, in coarse steps so that some never change. Some days miss an endpoint or have an empty one.
LAKE = f"""o AS (SELECT o_custkey % 100 AS n, 'S' || o_custkey % 100 AS sym, CAST(o_orderdate AS DATE) AS as_of, o_orderkey, o_totalprice, o_orderpriority AS p FROM orders),
man AS (SELECT as_of, endpoint, CASE WHEN (dayofyear(as_of) + k) % 17 = 0 THEN 'partial' ELSE 'ok' END AS status, CASE WHEN (dayofyear(as_of) * 3 + k) % 71 = 0 THEN 0 ELSE 5 END AS n_rows
  FROM (SELECT DISTINCT as_of FROM o), (VALUES {_ends}) e(k, endpoint) WHERE NOT (k = 3 AND dayofyear(as_of) % 29 = 0)),
days AS (SELECT as_of FROM man GROUP BY as_of HAVING count(DISTINCT CASE WHEN status = 'ok' AND n_rows > 0 THEN endpoint END) = 4),
est0 AS (SELECT sym, as_of, make_date(year(as_of) + k, 12, 31) AS fiscal_end, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE floor(o_totalprice / 125000) - 1 END AS eps, floor(o_totalprice / 250000) + 1 AS high, -2.0 AS low, 3.0 + n % 4 AS n_analysts
  FROM o, (VALUES (0), (1), (2)) y(k) WHERE p NOT IN ('1-URGENT', '2-HIGH') AND (o_orderkey + k) % 4 <> 0),
est AS (SELECT sym, as_of, fiscal_end, v.* FROM (SELECT sym, as_of, fiscal_end, max({{'eps': eps, 'high': high, 'low': low, 'n_analysts': n_analysts}} ORDER BY eps NULLS FIRST, high, low, n_analysts) AS v FROM est0 WHERE as_of IN (FROM days) GROUP BY ALL)),
tgt AS (SELECT sym, as_of, max(o_totalprice) AS target FROM o WHERE p = '1-URGENT' AND as_of IN (FROM days) GROUP BY ALL),
grd AS (SELECT sym, as_of, max((2.0 * (o_orderkey % 4) + o_orderkey % 3 - o_orderkey % 2 - 2 * (o_orderkey % 5)) / nullif(o_orderkey % 4 + o_orderkey % 3 + o_orderkey % 7 + o_orderkey % 2 + o_orderkey % 5, 0)) AS grade FROM o WHERE p = '2-HIGH' AND as_of IN (FROM days) GROUP BY ALL HAVING grade IS NOT NULL)"""
LAKE = LAKE.replace("max({'eps': eps, 'high': high, 'low': low, 'n_analysts': n_analysts} ORDER BY eps NULLS FIRST, high, low, n_analysts) AS v", "list({'eps': eps, 'high': high, 'low': low, 'n_analysts': n_analysts} ORDER BY eps DESC NULLS LAST, high DESC, low DESC, n_analysts DESC)[1] AS v")


def _off(day: str, n: int) -> str:
    """A weekday n business days from ``day``, by counting weekdays: a weekend counts as the Friday before."""
    back = f"({day} - CAST(greatest(isodow({day}) - 5, 0) AS INTEGER))"
    k = f"(least(isodow({day}), 5) - 1 + {n})"
    return f"({back} + CAST(floor({k} / 5.0) * 7 + ({k} - floor({k} / 5.0) * 5) - (least(isodow({day}), 5) - 1) AS INTEGER))"


def _window(k: str, n: int) -> str:
    """One window of every row: the snapshot by its start, that snapshot's estimate of the same year, and the year's rows
    between both, met one by one."""
    return f"""a_{k} AS (SELECT r.*, s.snap AS lag_snap FROM (SELECT sym, as_of, snap, fiscal_end, eps, {_off('as_of', -n)} AS tau FROM fy) r ASOF LEFT JOIN snaps s ON r.sym = s.sym AND r.tau >= s.snap),
b_{k} AS (SELECT a.*, e.eps AS lag_eps, e.sym IS NOT NULL AS there, (SELECT min(f.fiscal_end) FROM est f WHERE f.sym = a.sym AND f.as_of = a.lag_snap AND f.fiscal_end >= a.tau AND f.eps IS NOT NULL) AS lag_fy
  FROM a_{k} a LEFT JOIN est e ON e.sym = a.sym AND e.as_of = a.lag_snap AND e.fiscal_end = a.fiscal_end),
c_{k} AS (SELECT b.sym, b.as_of, count(CASE WHEN m.changed AND m.as_of > b.lag_snap THEN 1 END) AS changes, count(CASE WHEN m.up AND m.as_of > b.lag_snap THEN 1 END) AS ups, count(CASE WHEN m.down AND m.as_of > b.lag_snap THEN 1 END) AS downs
  FROM b_{k} b JOIN moves m ON m.sym = b.sym AND m.fiscal_end = b.fiscal_end AND m.as_of BETWEEN b.lag_snap AND b.as_of GROUP BY ALL),
n_{k} AS (SELECT b.sym, b.as_of, count(*) AS n_snaps FROM b_{k} b JOIN snaps s ON s.sym = b.sym AND s.snap BETWEEN b.tau AND b.as_of GROUP BY ALL),
d_{k} AS (SELECT b.*, c.changes, c.ups, c.downs, coalesce(n.n_snaps, 0) AS n_snaps, (b.eps - b.lag_eps) / nullif(abs(b.lag_eps), 0) AS raw,
  CASE WHEN b.snap IS NULL THEN 'no_snapshot' WHEN b.fiscal_end IS NULL THEN 'no_fy1' WHEN b.lag_snap IS NULL THEN 'no_lag_snapshot' WHEN b.lag_eps IS NULL THEN 'no_fy1_row_at_lag' WHEN b.lag_eps = 0 THEN 'zero_denominator' WHEN coalesce(c.changes, 0) = 0 THEN 'no_update_in_window' ELSE '' END AS reason
  FROM b_{k} b LEFT JOIN c_{k} c USING (sym, as_of) LEFT JOIN n_{k} n USING (sym, as_of))"""


REVISIONS = f"""WITH {LAKE}, snaps AS (SELECT DISTINCT sym, as_of AS snap FROM est),
moves AS (SELECT sym, fiscal_end, as_of, lag(as_of) OVER w IS NOT NULL AND (eps IS DISTINCT FROM lag(eps) OVER w OR high IS DISTINCT FROM lag(high) OVER w OR low IS DISTINCT FROM lag(low) OVER w OR n_analysts IS DISTINCT FROM lag(n_analysts) OVER w) AS changed, eps > lag(eps) OVER w AS up, eps < lag(eps) OVER w AS down
  FROM est WINDOW w AS (PARTITION BY sym, fiscal_end ORDER BY as_of)),
since AS (SELECT sym, min(as_of) AS since FROM (SELECT sym, as_of FROM est UNION ALL SELECT sym, as_of FROM tgt UNION ALL SELECT sym, as_of FROM grd) GROUP BY sym),
dom AS (SELECT sym, as_of FROM since JOIN days ON as_of >= since), now AS (SELECT d.sym, d.as_of, s.snap FROM dom d ASOF LEFT JOIN snaps s ON d.sym = s.sym AND d.as_of >= s.snap),
fy AS (SELECT n.sym, n.as_of, n.snap, e.fiscal_end, e.eps, e.n_analysts FROM now n LEFT JOIN est e ON e.sym = n.sym AND e.as_of = n.snap AND e.fiscal_end >= n.as_of AND e.eps IS NOT NULL QUALIFY row_number() OVER (PARTITION BY n.sym, n.as_of ORDER BY e.fiscal_end) = 1),
{', '.join(_window(k, n) for k, n in snapshots.WINDOWS.items())},
t1 AS (SELECT d.*, t.target FROM dom d ASOF LEFT JOIN tgt t ON d.sym = t.sym AND d.as_of >= t.as_of), t2 AS (SELECT d.sym, d.as_of, t.target AS target0 FROM (SELECT *, {_off('as_of', -21)} AS tau FROM dom) d ASOF LEFT JOIN tgt t ON d.sym = t.sym AND d.tau >= t.as_of),
g1 AS (SELECT d.*, g.grade FROM dom d ASOF LEFT JOIN grd g ON d.sym = g.sym AND d.as_of >= g.as_of), g2 AS (SELECT d.sym, d.as_of, g.grade AS grade0 FROM (SELECT *, {_off('as_of', -21)} AS tau FROM dom) d ASOF LEFT JOIN grd g ON d.sym = g.sym AND d.tau >= g.as_of)
SELECT f.sym AS symbol, f.as_of, {_off('f.as_of', 1)} AS usable_from, {', '.join(f"round(CASE WHEN d_{k}.reason = '' THEN d_{k}.raw END, 9) + 0.0 AS revision_drift_{k}" for k in snapshots.WINDOWS)},
  round(p.raw, 9) + 0.0 AS revision_drift_1m_raw, CASE WHEN p.lag_eps IS NOT NULL THEN round((p.ups - p.downs) / nullif(p.ups + p.downs, 0), 9) + 0.0 END AS revision_breadth_1m, p.lag_eps IS NOT NULL AND coalesce(p.changes, 0) > 0 AS fy1_updated_1m,
  p.lag_eps IS NOT NULL AND coalesce(p.lag_fy <> p.fiscal_end, FALSE) AS fy1_rolled_1m, CASE WHEN p.lag_eps IS NOT NULL THEN p.n_snaps ELSE 0 END AS n_est_snapshots_1m, p.lag_eps AS fy1_eps_avg_lag_1m, p.reason <> '' AS excluded_1m, p.reason AS excluded_reason_1m,
  f.fiscal_end AS fy1_fiscal_end, f.eps AS fy1_eps_avg, f.n_analysts AS fy1_num_analysts, round((t1.target - t2.target0) / nullif(abs(t2.target0), 0), 9) + 0.0 AS target_drift_1m, round(g1.grade - g2.grade0, 9) + 0.0 AS grade_migration_1m
FROM fy f JOIN d_5d ON d_5d.sym = f.sym AND d_5d.as_of = f.as_of JOIN d_1m p ON p.sym = f.sym AND p.as_of = f.as_of JOIN d_1m ON d_1m.sym = f.sym AND d_1m.as_of = f.as_of JOIN d_3m ON d_3m.sym = f.sym AND d_3m.as_of = f.as_of
JOIN t1 ON t1.sym = f.sym AND t1.as_of = f.as_of JOIN t2 ON t2.sym = f.sym AND t2.as_of = f.as_of JOIN g1 ON g1.sym = f.sym AND g1.as_of = f.as_of JOIN g2 ON g2.sym = f.sym AND g2.as_of = f.as_of"""


def _orders(spark, d):
    return t.table(spark, d, "orders").withColumns({"n": F.col("o_custkey") % 100, "as_of": F.to_date("o_orderdate"), "key": F.col("o_orderkey")}).withColumn("sym", F.concat(F.lit("S"), "n"))


def _manifests(spark, d):
    days = _orders(spark, d).select("as_of").distinct()
    ends = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.lit(e).alias("endpoint")) for k, e in enumerate(snapshots.ENDPOINTS))))
    x = days.select("as_of", ends.alias("e")).select("as_of", "e.*", F.dayofyear("as_of").alias("n")).where("not (k = 3 and n % 29 = 0)")
    return x.select("as_of", "endpoint", F.when((F.col("n") + F.col("k")) % 17 == 0, "partial").otherwise("ok").alias("status"), F.when((F.col("n") * 3 + F.col("k")) % 71 == 0, 0).otherwise(5).alias("n_rows"))


def _lake(spark, d):
    o = _orders(spark, d)
    est = o.where(~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("*", F.explode(F.array(*map(F.lit, range(3)))).alias("k")).where((F.col("key") + F.col("k")) % 4 != 0)
    eps = F.when(F.col("key") % 11 != 0, F.floor(F.col("o_totalprice") / 125000) - 1)
    est = est.select("sym", "as_of", F.make_date(F.year("as_of") + F.col("k"), F.lit(12), F.lit(31)).alias("fiscal_end"), eps.alias("eps"), (F.floor(F.col("o_totalprice") / 250000) + 1).alias("high"), F.lit(-2.0).alias("low"), (F.col("n") % 4 + 3).alias("n_analysts"))
    tgt = o.where("o_orderpriority = '1-URGENT'").select("sym", "as_of", F.col("o_totalprice").alias("target"))
    grd = o.where("o_orderpriority = '2-HIGH'").select("sym", "as_of", *((F.col("key") % m).alias(c) for c, m in (("strong_buy", 4), ("buy", 3), ("hold", 7), ("sell", 2), ("strong_sell", 5))))
    return _manifests(spark, d), est, tgt, grd


@query(REVISIONS)
def revision_features(spark, d):
    """The whole table of 19 columns; every reason for an exclusion occurs."""
    x = snapshots.revision_features(*_lake(spark, d))
    return x.withColumns({c: F.round(c, 9) + 0.0 for c in ("revision_drift_5d", "revision_drift_1m", "revision_drift_3m", "revision_drift_1m_raw", "revision_breadth_1m", "target_drift_1m", "grade_migration_1m")})


@query(f"SELECT as_of, count(*) AS n, round(avg(CASE WHEN excluded_1m THEN 1.0 ELSE 0.0 END), 6) AS excluded FROM ({REVISIONS}) GROUP BY as_of")
def revision_exclusions(spark, d):
    return snapshots.exclusions(snapshots.revision_features(*_lake(spark, d))).withColumn("excluded", F.round("excluded", 6))


@query(f"WITH {LAKE}, a AS (SELECT min(as_of) AS anchor FROM days) SELECT anchor, CAST(anchor + INTERVAL 6 MONTH AS DATE) AS confirmatory_unlock, CAST(anchor + INTERVAL 9 MONTH AS DATE) AS second_checkpoint, {', '.join(f'{_off("anchor", n)} AS mature_{k}' for k, n in snapshots.WINDOWS.items())} FROM a")
def revision_readiness(spark, d):
    return snapshots.readiness(_manifests(spark, d))


@query(f"WITH {LAKE}, e AS (SELECT CAST(unnest(generate_series((SELECT min(as_of) FROM days), (SELECT max(as_of) FROM days), INTERVAL 1 DAY)) AS DATE) AS as_of) SELECT as_of FROM e WHERE isodow(as_of) <= 5 AND as_of NOT IN (FROM days)")
def unpublished_weekdays(spark, d):
    return snapshots.unpublished_weekdays(_manifests(spark, d))
