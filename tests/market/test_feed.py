import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.operators import as_filed, feed, snapshots
from tessera.plans import as_filed_queries, feed_queries, snapshot_queries

day = dt.date.fromisoformat
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in ("lineitem", "part", "orders"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_every_case_occurs_in_the_oracles(db):
    assert {r[0] for r in db.execute(f"WITH {feed_queries.QUARTERLY} SELECT DISTINCT source FROM qq").fetchall()} == {"filed", "accepted", "expected"}
    reasons = {r[0] for r in db.execute(f"SELECT DISTINCT excluded_reason_1m FROM ({snapshot_queries.REVISIONS})").fetchall()}
    assert reasons == {"", "no_snapshot", "no_fy1", "no_lag_snapshot", "no_fy1_row_at_lag", "zero_denominator", "no_update_in_window"}
    n = db.execute(f"SELECT count(earnings_yield), count(roe), count(gross_profitability), count(asset_growth), count(*) - count(market_cap) FROM ({as_filed_queries.AS_FILED})").fetchone()
    assert all(x > 100 for x in n)


def facts(spark, rows):
    return spark.createDataFrame([(c, day(e), k, day(f) if f else None, v) for c, e, k, f, v in rows], "cik long, period_end date, concept string, filed date, val double")


def test_tiers_fan_out_and_carry_forward(spark):
    """An undated value wins; a concept that the newest filing lacks keeps its own source; both share classes get all rows."""
    rows = [
        (1, "2020-03-31", "NetIncomeLoss", "2020-05-01", 10.0), (1, "2020-03-31", "NetIncomeLoss", "2020-06-01", 11.0), (1, "2020-03-31", "CommonStockSharesOutstanding", "2020-05-01", 100.0),
        (1, "2020-06-30", "NetIncomeLoss", None, 20.0), (1, "2020-06-30", "NetIncomeLoss", "2020-08-01", 19.0), (1, "2020-09-30", "Revenues", None, None),
        (2, "2020-03-31", "Assets", "2020-05-01", 1.0),
    ]
    ciks = spark.createDataFrame([(1, "a"), (1, "a.b"), (1, "a"), (3, "c"), (2, None)], "cik long, sym string")
    accepted = spark.createDataFrame([("A", day("2020-06-30"), dt.datetime(2020, 8, 5, 18), day("2020-08-06")), ("A", day("2020-06-30"), dt.datetime(2020, 6, 1), None)], "sym string, period_end date, accepted timestamp, filed date")
    q = feed.quarterly(facts(spark, rows), ciks, accepted)
    got = {(r.sym, str(r.period_end)): (r.NetIncomeLoss, str(r.available), r.source) for r in q.collect()}
    assert got == {
        ("A", "2020-03-31"): (11.0, "2020-06-01", "filed"), ("A.B", "2020-03-31"): (11.0, "2020-06-01", "filed"), ("A", "2020-06-30"): (20.0, "2020-08-06", "accepted"),
        ("A.B", "2020-06-30"): (20.0, "2020-08-29", "expected"), ("A", "2020-09-30"): (None, "2020-11-29", "expected"), ("A.B", "2020-09-30"): (None, "2020-11-29", "expected"),
    }
    prices = spark.createDataFrame([("A", day("2020-06-02"), 2.0), ("A", day("2020-12-01"), 4.0), ("B", day("2020-12-02"), 1.0)], "sym string, d date, c double")
    out = {str(r.d): r for r in feed.checked(feed.ratios(feed.carried(q, prices, feed.serving_days(prices, q)))).collect()}
    assert sorted(out) == ["2020-06-02", "2020-12-01", "2020-12-02"] and {r.sym for r in out.values()} == {"A"}
    late = out["2020-12-01"]
    assert late.earnings_yield == pytest.approx(20 / 400) and str(late.earnings_yield_source_available_at) == "2020-06-01" and late.earnings_yield_source_age_days == 183
    assert str(late.available_at) == "2020-11-29" and str(late.fiscal_period_end) == "2020-09-30" and out["2020-12-02"].price is None and out["2020-12-02"].earnings_yield is None
    v = {r.feature: r for r in feed.verdict(feed.ratios(feed.carried(q, prices, feed.serving_days(prices, q))), ciks.select("sym")).collect()}
    assert (v["roe"].n_have, v["roe"].n_expected, v["roe"].n_universe, v["roe"].n_priced, v["roe"].coverage_ok, v["roe"].freshness_ok) == (0, 1, 3, 0, False, True)


def test_checks_hold_whatever_is_read(spark):
    bad = spark.createDataFrame([("A", day("2020-01-01"), day("2020-01-02"), day("2019-12-31"))], "sym string, d date, available_at date, fiscal_period_end date")
    for use in (lambda x: x.count(), lambda x: x.select("sym").collect()):
        with pytest.raises(Exception, match="not yet available"):
            use(feed.checked(bad))
    assert feed.checked(bad.where("false")).count() == 0


def test_factor_before_the_first_day(spark):
    f = spark.createDataFrame([("A", day("2020-01-10"), 4.0), ("A", day("2020-02-01"), 2.0)], "sym string, d date, factor double")
    s = spark.createDataFrame([("A", day("2020-01-05"), 3.0), ("A", day("2020-01-10"), 5.0), ("A", day("2020-01-20"), 7.0)], "sym string, d date, ratio double")
    ask = spark.createDataFrame([("A", day(x)) for x in ("2020-01-04", "2020-01-05", "2020-01-09", "2020-01-10", "2020-03-01")] + [("B", day("2020-01-01"))], "sym string, d date")
    got = {(r.sym, str(r.d)): r.fac for r in as_filed.factor_at(ask, f, s).collect()}
    assert got == {("A", "2020-01-04"): 60.0, ("A", "2020-01-05"): 20.0, ("A", "2020-01-09"): 20.0, ("A", "2020-01-10"): 4.0, ("A", "2020-03-01"): 2.0, ("B", "2020-01-01"): None}


def test_trailing_year_and_fourth_quarter(spark):
    rows = [("A", "NetIncomeLoss", s, e, f, v) for s, e, f, v in (("2020-01-01", "2020-03-31", "2020-05-01", 1.0), ("2020-04-01", "2020-06-30", "2020-08-01", 2.0), ("2020-07-01", "2020-09-30", "2020-11-01", 3.0), ("2020-01-01", "2020-12-31", "2021-02-01", 10.0), ("2021-04-01", "2021-06-30", "2021-08-01", 5.0), ("2020-01-01", "2020-03-31", "2020-04-01", 1.5), ("2021-01-01", "2021-03-31", "2021-03-01", 9.0))]
    df = spark.createDataFrame([(a, b, day(c), day(d), day(e), f) for a, b, c, d, e, f in rows], "sym string, concept string, start date, end date, filed date, val double")
    got = {str(r.end): (str(r.ni.filed), r.ni.val) for r in as_filed.trailing(as_filed.by_quantity(as_filed.first_filed(df))).collect()}
    # the quarter that was filed before it ended is no fact; quarters of June 2020 to June 2021 lie 365 days apart
    assert got == {"2020-12-31": ("2021-02-01", 10.0), "2021-06-30": ("2021-08-01", 2.0 + 3.0 + 3.5 + 5.0)}


def test_published_days_need_all_endpoints(spark):
    rows = [(day("2020-01-01"), e, "ok", 1) for e in snapshots.ENDPOINTS] + [(day("2020-01-02"), e, "ok", int(e != "grades_consensus")) for e in snapshots.ENDPOINTS] + [(day("2020-01-03"), e, "ok", 1) for e in snapshots.ENDPOINTS[:3]]
    rows += [(day("2020-01-03"), "other", "ok", 1), (day("2020-01-03"), snapshots.ENDPOINTS[0], "ok", 1)]
    man = spark.createDataFrame(rows, "as_of date, endpoint string, status string, n_rows int")
    assert [str(r.as_of) for r in snapshots.published(man).collect()] == ["2020-01-01"]
    empty = spark.createDataFrame([], "sym string, as_of date, fiscal_end date, eps double, high double, low double, n_analysts double")
    grades = spark.createDataFrame([("A", day("2020-01-01"), 1, 0, 0, 0, 0), ("B", day("2020-01-02"), 1, 0, 0, 0, 0)], "sym string, as_of date, strong_buy int, buy int, hold int, sell int, strong_sell int")
    out = snapshots.revision_features(man, empty, empty.select("sym", "as_of", F.col("eps").alias("target")), grades)
    assert len(out.columns) == 19 and [(r.symbol, r.excluded_reason_1m, r.excluded_1m, r.n_est_snapshots_1m) for r in out.collect()] == [("A", "no_snapshot", True, 0)]
