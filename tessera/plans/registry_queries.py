"""Registered queries, tenth part: contracts behind manifests, and the panel of pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import pairs
from tessera.plans import sql
from tessera.plans.queries import query, rounded
from tessera.sources import registry
from tessera.sources import tables as t

#: Regions' manifests refer to nations', these to their customers' contracts and back to the region; some files are missing, some broken.
SCANNED = """cu AS (SELECT c_custkey AS k, c_nationkey AS n, c_acctbal AS b FROM customer WHERE c_custkey % 5 = 0 AND c_nationkey <> 7), there AS (SELECT * FROM cu WHERE k % 15 <> 0),
con AS (SELECT '/x/r' || r_regionkey || '.json' AS file, 'manifest' AS status, NULL AS n_feature_cols, NULL AS banned, NULL AS dataset_recorded FROM region UNION ALL SELECT '/x/n/n' || n_nationkey || '.json', 'manifest', NULL, NULL, NULL FROM nation
  UNION ALL SELECT '/x/c/c' || k || '.pt.metadata.json', CASE WHEN k % 35 = 0 THEN 'unparseable' ELSE 'contract' END, CASE WHEN k % 35 <> 0 THEN CASE WHEN b < 0 THEN 3 ELSE 2 END END, CASE WHEN k % 35 <> 0 THEN CASE WHEN b < 0 THEN 'tone' ELSE '' END END, CASE WHEN k % 35 <> 0 THEN k % 10 = 0 END FROM there),
lost AS (SELECT '/x/n/n' || n || '.json' AS file, 'c/c' || k || '.pt' AS uri FROM cu WHERE k % 15 = 0)"""


def _scan(spark, d):
    cu = t.table(spark, d, "customer").where("c_custkey % 5 = 0 and c_nationkey <> 7").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("n"), F.col("c_acctbal").alias("b"))
    na = t.table(spark, d, "nation")
    refs = lambda uris: F.to_json(F.struct(F.transform(uris, lambda u: F.struct(u.alias("artifact_uri"))).alias("retrains")))
    regions = na.groupBy("n_regionkey").agg(F.collect_list(F.concat(F.lit("n/n"), "n_nationkey", F.lit(".json"))).alias("u")).select(F.concat(F.lit("/x/r"), "n_regionkey", F.lit(".json")).alias("file"), refs(F.col("u")).alias("json"))
    own = cu.groupBy("n").agg(F.collect_list(F.concat(F.lit("c/c"), "k", F.lit(".pt"))).alias("u"))
    up = F.concat(F.array(F.concat(F.lit("r"), "n_regionkey", F.lit(".json"))), F.coalesce("u", F.array().cast("array<string>")))
    nations = na.join(own, F.col("n") == F.col("n_nationkey"), "left").select(F.concat(F.lit("/x/n/n"), "n_nationkey", F.lit(".json")).alias("file"), refs(up).alias("json"))
    names = F.concat(F.array(F.lit("f1"), F.lit("f2")), F.when(F.col("b") < 0, F.array(F.lit("tone"))).otherwise(F.array().cast("array<string>")))
    body = F.to_json(F.struct(names.alias("feature_cols"), F.when(F.col("k") % 10 == 0, F.struct(F.lit("s").alias("dataset"))).alias("training_contract")))
    contracts = cu.where("k % 15 <> 0").select(F.concat(F.lit("/x/c/c"), "k", F.lit(".pt.metadata.json")).alias("file"), F.when(F.col("k") % 35 == 0, F.substring(body, 1, 9)).otherwise(body).alias("json"))
    return registry.scan(regions.unionByName(nations).unionByName(contracts), regions, ["tone", "n_articles"])


@query(f"WITH {SCANNED} SELECT * FROM con")
def contract_scan(spark, d):
    return _scan(spark, d)[0]


@query(f"WITH {SCANNED} SELECT count(*) AS n_scanned, {', '.join(f'count(CASE status WHEN {s!r} THEN 1 END) AS n_{s}' for s in ('contract', 'manifest', 'no_feature_cols', 'unparseable'))}, count(CASE WHEN banned <> '' THEN 1 END) AS n_violations, count(CASE WHEN banned <> '' AND NOT dataset_recorded THEN 1 END) AS n_exposed, (SELECT count(*) FROM lost) AS n_unresolved, count(CASE WHEN banned <> '' OR status = 'unparseable' THEN 1 END) = 0 AND (SELECT count(*) FROM lost) = 0 AS holds FROM con")
def contract_verdict(spark, d):
    return registry.verdict(*_scan(spark, d))


_h = pairs.HORIZONS
PAIRS = f"""WITH {sql.BARS}, {sql.PREPARED}, cl AS (SELECT sym, d, c, CASE WHEN day(d) % 3 = 0 THEN CAST(d + 1 AS TIMESTAMP) + INTERVAL 2 HOUR ELSE CAST(d + 1 AS TIMESTAMP) END AS bar_close FROM bars),
lb AS (SELECT b.sym, b.d, b.bar_close, {', '.join(f'e{n}.c / b.c - 1 AS fwd_{n}d, e{n}.bar_close AS av_{n}' for n in _h)} FROM cl b {' '.join(f'LEFT JOIN cl e{n} ON e{n}.sym = b.sym AND e{n}.d = b.d + {n}' for n in _h)}),
ft AS (SELECT sym, d, t, {', '.join(f"lag(c, {n}) OVER s / c AS ROC{n}, CASE WHEN count(c) OVER w{n} >= {n} THEN avg(c) OVER w{n} END / c AS MA{n}" for n in (5, 10, 20, 30, 60))} FROM q {sql.windows((5, 10, 20, 30, 60))})
SELECT f.sym, f.d, l.bar_close, {', '.join(f'round(ROC{n} + 1e-9, 6) + 0.0 AS ROC{n}, round(MA{n} + 1e-9, 6) + 0.0 AS MA{n}' for n in (5, 10, 20, 30, 60))}, {', '.join(f"round(l.fwd_{n}d + 1e-9, 6) + 0.0 AS fwd_{n}d, l.av_{n} AS available_after_{n}d, CASE WHEN l.sym <> 'Brand#11' THEN round(l.fwd_{n}d - b.fwd_{n}d + 1e-9, 6) + 0.0 END AS fwd_{n}d_excess, CASE WHEN l.sym <> 'Brand#11' AND l.fwd_{n}d - b.fwd_{n}d IS NOT NULL THEN greatest(l.av_{n}, b.av_{n}) END AS excess_available_after_{n}d" for n in _h)}
FROM ft f JOIN lb l ON l.sym = f.sym AND l.d = f.d LEFT JOIN lb b ON b.sym = 'Brand#11' AND b.d = l.d WHERE f.t > 69"""


@query(PAIRS)
def pair_panel(spark, d):
    """Brands as pairs, one of them as the benchmark; a third of the bars closed two hours late. The manifest has passed all."""
    late = F.when(F.dayofmonth("d") % 3 == 0, F.date_add("d", 1).cast("timestamp") + F.expr("INTERVAL 2 HOURS"))
    bars = t.bars_daily(spark, d).withColumn("bar_close", late)
    passed = bars.select("sym", F.lit(None).cast("string").alias("problem")).distinct()
    return rounded(pairs.panel(bars, "Brand#11", passed, only={"ROC", "MA"}), bump=1e-9)
