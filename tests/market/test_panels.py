import datetime as dt
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import fundamentals, panels, technical
from tessera.sources import parsers

day = dt.date.fromisoformat


def test_company_facts(spark):
    entry = lambda **k: {"start": "2020-01-01", "end": "2020-03-31", "val": 5.0, "form": "10-Q", "filed": "2020-05-01", "fy": 2020, "fp": "Q1"} | k
    doc = {"facts": {"us-gaap": {"Revenues": {"units": {"USD": [entry(), entry(form="8-K"), entry(val=None)], "EUR": [entry()]}}, "EarningsPerShareDiluted": {"units": {"USD/shares": [entry(val=1.5)], "USD": [entry()]}}, "Other": {"units": {"USD": [entry()]}}}, "dei": {"Revenues": {"units": {"USD": [entry()]}}}}}
    raw = spark.createDataFrame([("A", json.dumps(doc)), ("B", "no json"), ("C", "{}"), ("D", None)], "sym string, json string")
    got = sorted((r.sym, r.field, r.val, r.period_end, r.filed) for r in parsers.company_facts(raw, {"Revenues": "revenue", "EarningsPerShareDiluted": "eps"}).where("val is not null").collect())
    assert got == [("A", "eps", 1.5, day("2020-03-31"), day("2020-05-01")), ("A", "revenue", 5.0, day("2020-03-31"), day("2020-05-01"))]
    assert parsers.company_facts(raw, {"Revenues": "revenue"}).count() == 2  # one without a value


def test_filing_dates_and_restamping(spark):
    page = lambda *rows: json.dumps(dict(zip(("accessionNumber", "form", "reportDate", "filingDate", "acceptanceDateTime"), map(list, zip(*rows)))))
    first = page(("1", "10-Q", "2020-03-31", "2020-05-01", "2020-05-01T18:00:00.000Z"), ("2", "8-K", "2020-03-31", "2020-05-02", "2020-05-02T10:00:00.000Z"), ("3", "10-K", "2013-12-31", "2014-02-01", "2014-02-01T10:00:00.000Z"))
    again = page(("4", "10-Q", "2020-03-31", "2020-06-01", "2020-06-01T18:00:00.000Z"), ("5", "10-K", "2019-12-31", "2020-02-03", "2020-02-03T10:00:00.000Z"))
    raw = spark.createDataFrame([("A", 0, first), ("A", 1, again), ("B", 0, first), ("B", 1, None)], "sym string, page int, json string")
    got = parsers.filing_dates(raw, "2014-01-01")
    assert sorted((r.sym, r.form, r.period_end, r.filed) for r in got.collect()) == [("A", "10-K", day("2019-12-31"), day("2020-02-03")), ("A", "10-Q", day("2020-03-31"), day("2020-05-01"))]
    rows = spark.createDataFrame([("A", day("2020-03-31"), day("2020-05-30")), ("A", day("2020-06-30"), day("2020-08-29")), ("B", day("2020-03-31"), None)], "sym string, period_end date, available date")
    out = sorted((r.sym, r.available, r.available_source) for r in parsers.restamped(rows, got).collect())
    assert out == [("A", day("2020-05-04"), "accepted"), ("A", day("2020-08-29"), "carried")]  # a Friday's filing, from Monday on


def test_officer_trades(spark):
    trade = lambda code, side, n="100", p="2.5": f"<nonDerivativeTransaction><transactionDate><value>2021-02-03</value></transactionDate><transactionCoding><transactionCode>{code}</transactionCode></transactionCoding><transactionAmounts><transactionShares><value>{n}</value></transactionShares>" + (f"<transactionPricePerShare>\n <value>{p}</value></transactionPricePerShare>" if p else "") + f"<transactionAcquiredDisposedCode><value>{side}</value></transactionAcquiredDisposedCode></transactionAmounts></nonDerivativeTransaction>"
    xml = lambda officer, *t: f"<ownershipDocument><reportingOwnerRelationship><isOfficer>{officer}</isOfficer></reportingOwnerRelationship>{''.join(t)}<derivativeTransaction>{t[0][26:-27]}</derivativeTransaction></ownershipDocument>"
    rows = [("A", xml("true", trade("P", "A"), trade("S", "D", "40"), trade("M", "A"), trade("P", "A", "x"), trade("S", "D", "7", None), trade("P", "A", "1", "free"))), ("B", xml("0", trade("P", "A"))), ("C", None), ("D", "<a/>")]
    got = sorted((r.sym, str(r.d), r.code, r.shares, r.dollars) for r in parsers.officer_trades(spark.createDataFrame(rows, "sym string, xml string")).fillna(-1.0, ["dollars"]).collect())
    assert got == [("A", "2021-02-03", "P", 100.0, 250.0), ("A", "2021-02-03", "S", -40.0, -100.0), ("A", "2021-02-03", "S", -7.0, -1.0)]


def test_fetch_status_and_spellings(spark):
    rows = [(402, None, None), (None, "Special Endpoint: rate limit", None), (429, "premium", None), (None, "Limit Reached", None), (None, "boom", 3), (None, None, None), (None, None, 0), (None, None, 4)]
    df = spark.createDataFrame(rows, "http int, message string, n int")
    got = [r[0] for r in df.select(parsers.fetch_status(F.col("http"), F.col("message"), F.col("n"))).collect()]
    assert got == ["premium_restricted", "premium_restricted", "premium_restricted", "quota_error", "fetch_error", "fetch_error", "no_coverage", "with_data"]
    ciks = spark.createDataFrame([("BRK-B", 7), ("BF.B", 8), ("A", 1)], "sym string, cik long")
    names = spark.createDataFrame([("brk.b",), ("BF-B",), ("A",), ("ZZ",)], "sym string")
    assert {r.sym: r.cik for r in parsers.cik_of(names, ciks).collect()} == {"brk.b": 7, "BF-B": 8, "A": 1, "ZZ": None}


def test_a_second_row_of_a_key_stops_the_join(spark):
    panel = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "sym string, d int")
    other = spark.createDataFrame([("a", 1, 5.0), ("c", 1, 6.0)], "sym string, d int, x double")
    assert sorted((r.sym, r.d, r.x) for r in panels.attach(panel, other, ["sym", "d"]).collect()) == [("a", 1, 5.0), ("a", 2, None), ("b", 1, None)]
    with pytest.raises(Exception, match="rows of one key"):
        panels.attach(panel, other.union(other), ["sym", "d"]).collect()


def test_standardised_features_do_not_see_other_splits(spark):
    rng = np.random.default_rng(0)
    rows = [(f"s{i % 7}", i, float(x), float("inf") if i == 3 else 1.0, "train" if i < 300 else "test") for i, x in enumerate(rng.normal(size=400))]
    df = spark.createDataFrame(rows, "sym string, d int, x double, flat double, split string")
    out = panels.train_standardised(df, ["x", "flat"], tails=0.01).toPandas().set_index("d").sort_index()
    x = pd.Series([r[2] for r in rows])
    clip = x.clip(*x[:300].quantile([0.01, 0.99]))
    assert np.allclose(out["x"], ((clip - clip[:300].mean()) / clip[:300].std()).clip(-5, 5)) and (out["flat"] == 0).all()
    got = {r.feature: (r.n, r.enough) for r in panels.train_history(df, ["x", "flat"], 300).collect()}
    assert got == {"x": (300, True), "flat": (299, False)}


def test_growth_pads_gaps(spark):
    df = spark.createDataFrame([("a", k, v) for k, v in enumerate([1.0, None, 2.0, None, 4.0])], "sym string, d int, x double")
    got = [r.g for r in df.select("d", fundamentals.growth(F.col("x"), 2).alias("g")).orderBy("d").collect()]
    assert got == [None, None, 1.0, 1.0, 1.0]


def test_indicators_as_in_pandas(spark):
    rng = np.random.default_rng(2)
    c = 100 + np.cumsum(np.r_[np.full(20, 0.0), rng.normal(size=80)])
    p = pd.DataFrame({"c": c, "h": c + rng.random(100), "l": c - rng.random(100), "v": rng.integers(1, 9, 100).astype(float)})
    bars = spark.createDataFrame([("a", i, *map(float, r)) for i, r in enumerate(p.to_numpy())], "sym string, d int, c double, h double, l double, v double")
    smooth = lambda x: x.ewm(alpha=1 / 14, adjust=False, min_periods=14).mean()
    delta = p.c.diff()
    gain, loss = smooth(delta.clip(lower=0)), smooth(-delta.clip(upper=0))
    up, down = p.h.diff(), -p.l.diff()
    tr = pd.concat([p.h - p.l, (p.h - p.c.shift()).abs(), (p.l - p.c.shift()).abs()], axis=1).max(axis=1)
    plus, minus = (100 * smooth(x) / smooth(tr) for x in (up.where((up > down) & (up > 0), 0.0), down.where((down > up) & (down > 0), 0.0)))
    obv = (np.sign(delta) * p.v).fillna(0).cumsum().ewm(span=20, adjust=False).mean()
    want = {"rsi": 100 - 100 / (1 + gain / loss.replace(0, np.nan)), "adx": smooth(100 * (plus - minus).abs() / (plus + minus).replace(0, np.nan)), "obv_slope": obv.diff(5) / obv.shift(5).replace(0, np.nan)}
    for name, f in (("rsi", technical.rsi), ("adx", technical.adx), ("obv_slope", technical.obv_slope)):
        got = f(bars).toPandas().set_index("d").sort_index()[name].astype(float)
        assert np.allclose(got, want[name], equal_nan=True), name
    auto = technical.windowed(bars).toPandas().set_index("d").sort_index()["autocorr"].astype(float)
    assert auto[20] == 0 and auto[:20].isna().all() and auto[25:].notna().all()
