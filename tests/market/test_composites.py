import datetime as dt
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import equity, pairs, relative
from tessera.plans.equity_queries import equity_alpha_panel
from tessera.sources import registry

day = dt.date.fromisoformat


def test_a_short_training_history_stops_the_panel(spark):
    """Six bars a month are too few for windows of a year: no factor has its 252 training values."""
    with pytest.raises(Exception, match="too short a training history: beta_dm, mom_carry_12_1"):
        equity_alpha_panel(spark, "/root/testdata/sf0.001").count()


def test_the_panel_must_not_run_beyond_the_fundamentals(spark):
    panel = spark.createDataFrame([("A", day("2020-01-01")), ("A", day("2020-01-03"))], "sym string, d date")
    feed = spark.createDataFrame([("A", day("2020-01-02"))], "sym string, d date")
    assert equity.covered(panel, feed, True).count() == 1
    with pytest.raises(Exception, match="end on 2020-01-02"):
        equity.covered(panel, feed, False).select("sym").collect()


def test_surprises_fade_to_zero_and_drift_to_the_median(spark):
    earn = spark.createDataFrame([("A", day(x), s) for x, s in (("2020-01-01", 0.1), ("2020-01-11", 0.3), ("2020-01-21", -0.2))] + [("B", day("2020-01-31"), 0.5)], "sym string, d date, surprise double")
    panel = spark.createDataFrame([(s, day(x), 1) for s in "ABC" for x in ("2020-02-02", "2020-06-01")], "sym string, d date, other int")
    got = {(r.sym, str(r.d)): r for r in equity.with_events(panel, earn).collect()}
    a, b, c = (got[s, "2020-02-02"] for s in "ABC")
    assert (a.days_since_earnings, b.days_since_earnings, c.days_since_earnings) == (12.0, 2.0, 7.0)  # C: the median
    assert a.pead_signal == pytest.approx(-0.2 * 0.8) and a.pead_quintile_rank == 0.5 and b.pead_quintile_rank == 1.0 and c.pead_quintile_rank == 0.75
    assert a.surprise_momentum == pytest.approx(-0.5 * 0.8) and a.surprise_streak == pytest.approx(-0.8) and b.surprise_momentum == pytest.approx(-0.4)  # B's first event: the median
    late = [got[s, "2020-06-01"] for s in "ABC"]
    assert all(r.surprise_momentum == 0.0 and r.days_since_earnings == 0.0 for r in late) and late[0].other == 1


def test_sentiment_must_have_one_row_for_each_day(spark):
    panel = spark.createDataFrame([("A", day("2021-01-01")), ("B", day("2021-01-01"))], "sym string, d date")
    s = spark.createDataFrame([("A", day("2021-01-01"), 3, 0.5), ("A", day("2019-01-01"), 9, 9.0)], "sym string, d date, n_articles int, tone double")
    got = {r.sym: (r.tone, round(r.n_articles_log, 6)) for r in equity.with_sentiment(panel, s, ["tone"]).collect()}
    assert got == {"A": (0.5, round(np.log(4), 6)), "B": (0.5, round(np.log(4), 6))}
    with pytest.raises(Exception, match="rows of one key"):
        equity.with_sentiment(panel, s.union(s), ["tone"]).select("sym").collect()


def test_labels_are_known_when_the_later_bar_closes(spark):
    at = lambda x: dt.datetime.fromisoformat(x)
    rows = [("X", day("2020-01-01"), 2.0, None), ("X", day("2020-01-02"), 3.0, at("2020-01-03T01:00:00")), ("X", day("2020-01-04"), 4.0, None), ("M", day("2020-01-01"), 1.0, None), ("M", day("2020-01-02"), 1.1, at("2020-01-03T02:00:00")), ("Y", day("2020-01-03"), 1.0, None), ("Y", day("2020-01-04"), 1.5, None)]
    bars = pairs.closes(spark.createDataFrame(rows, "sym string, d date, c double, bar_close timestamp"))
    got = {(r.sym, r.d.day): r for r in pairs.labels(bars, "M", (1, 3)).collect()}
    x = got["X", 1]
    assert (x.fwd_1d, x.available_after_1d, x.fwd_3d, x.available_after_3d) == (0.5, at("2020-01-03T01:00:00"), 1.0, at("2020-01-05T00:00:00"))
    assert x.fwd_1d_excess == pytest.approx(0.4) and x.excess_available_after_1d == at("2020-01-03T02:00:00") and x.fwd_3d_excess is None and x.excess_available_after_3d is None
    assert got["M", 1].fwd_1d == pytest.approx(0.1) and got["M", 1].fwd_1d_excess is None and got["Y", 3].fwd_1d == 0.5 and got["Y", 3].fwd_1d_excess is None and got["X", 2].fwd_1d is None


def test_pairs_need_a_passed_manifest_and_enough_of_them(spark):
    bars = spark.range(100).select(F.explode(F.array(F.lit("X"), F.lit("M"))).alias("sym"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("d"), *(F.lit(1.0 + k).alias(c) for k, c in enumerate("ohlcv")))
    verdicts = lambda *x: spark.createDataFrame(list(x), "sym string, problem string")
    run = lambda p, **k: pairs.panel(bars, "M", p, only={"ROC"}, least_days=k.get("days", 10)).select("sym").count()
    assert run(verdicts(("X", None), ("M", None))) == 62 and run(None) == 62
    for p, why in ((verdicts(("X", None), ("M", "fingerprint")), "M: fingerprint"), (verdicts(("X", None)), "M: no verdict")):
        with pytest.raises(Exception, match=why):
            run(p)
    with pytest.raises(Exception, match="too few symbols or days: 2 31"):
        run(None, days=40)


def manifest(**k):
    return {"dataset_id": "a", "schema_version": "1", "fingerprint": "f", "uri": "store://a", "asset_class": "x"} | k


def test_the_registry_has_exactly_one(spark, tmp_path):
    for name, m in (("a", manifest()), ("b", manifest(dataset_id="b", asset_class="y")), ("c", manifest(dataset_id="c", uri="")), ("d", manifest(dataset_id="d", uri="/home/me/x")), ("e", manifest(dataset_id="e")), ("f", manifest(dataset_id="e"))):
        (tmp_path / f"{name}.json").write_text(json.dumps(m))
    files = registry.files(spark, str(tmp_path))
    assert registry.select(files, dataset_id="a", asset_class=None).first().uri == "store://a" and registry.select(files, asset_class="y").first().dataset_id == "b"
    for wanted, why in (("z", "no manifest has"), ("e", "more than one manifest: .*e.json, .*f.json"), ("c", "fields are missing: uri"), ("d", "path of one machine")):
        with pytest.raises(Exception, match=why):
            registry.select(files, dataset_id=wanted).count()


def test_references_are_followed_to_their_end(spark, tmp_path):
    """Three levels, a circle, the nearest of two places, a contract beside a checkpoint, a lost and an empty reference."""
    refer = lambda *u: json.dumps({"retrains": [{"artifact_uri": x} if x else {} for x in u]})
    rows = {
        "top.json": refer("sub/mid.json", "gone.json", None), "sub/mid.json": refer("cut.pt", "near.json", "top.json", "/s/abs.json"), "cut.pt.metadata.json": json.dumps({"feature_cols": ["x", "tone"], "dataset": "d"}),
        "sub/near.json": json.dumps({"feature_cols": ["x"], "training_contract": {"dataset": ""}}), "near.json": "{broken", "/s/abs.json": "[1, 2]", "alone.json": "{}", "sub/never.json": "{broken",
    }
    files = spark.createDataFrame([(k if k.startswith("/") else f"/r/{k}", v) for k, v in rows.items()], "file string, json string")
    contracts, unresolved = registry.scan(files, spark.createDataFrame([("/r/top.json",), ("/r/alone.json",)], "file string"), ["tone"])
    got = {r.file: (r.status, r.banned, r.dataset_recorded) for r in contracts.collect()}
    assert got == {
        "/r/top.json": ("manifest", None, None), "/r/sub/mid.json": ("manifest", None, None), "/r/cut.pt.metadata.json": ("contract", "tone", True), "/r/sub/near.json": ("contract", "", False),
        "/s/abs.json": ("no_feature_cols", None, False), "/r/alone.json": ("no_feature_cols", None, False),
    }
    assert sorted((r.file, r.uri or "") for r in unresolved.collect()) == [("/r/top.json", ""), ("/r/top.json", "gone.json")]
    v = registry.verdict(contracts, unresolved).first()
    assert (v.n_scanned, v.n_violations, v.n_exposed, v.n_unparseable, v.n_unresolved, v.holds) == (6, 1, 0, 0, 2, False)


def test_hurst_equals_numpy(spark):
    rng = np.random.default_rng(1)
    r = rng.normal(size=120)
    df = spark.createDataFrame([("A", i, float(x)) for i, x in enumerate(r)], "sym string, d int, r double")
    got = {x.d: x.h for x in df.select("d", relative.hurst(F.col("r")).alias("h")).collect()}

    def rs(x, n):
        out = []
        for k in range(0, len(x) - n + 1, n):
            c = x[k : k + n] - x[k : k + n].mean()
            out.append((np.cumsum(c).max() - np.cumsum(c).min()) / c.std())
        return np.mean(out)

    for i in (61, 62, 90, 119):
        w = r[max(0, i - 62) : i + 1]
        want = np.polyfit(np.log([7, 21, 63]), np.log([rs(w, n) if n != 21 else 1.0 for n in (7, 21, 63)]), 1)[0] if len(w) == 63 else None
        assert got[i] == (pytest.approx(want) if want is not None else None)


def test_indicators_equal_pandas(spark):
    rng = np.random.default_rng(2)
    c = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, 150)))
    h, lo, v = c * (1 + rng.random(150) / 50), c * (1 - rng.random(150) / 50), rng.integers(1, 100, 150).astype(float)
    p = pd.DataFrame({"sym": "A", "d": range(150), "o": c, "h": h, "l": lo, "c": c, "v": v})
    got = relative.indicators(spark.createDataFrame(p)).toPandas().sort_values("d").reset_index(drop=True)
    ew = lambda s, a, least=0: s.ewm(alpha=a, adjust=False, min_periods=least).mean()
    diff, tr = p.c.diff(), pd.concat([p.h - p.l, (p.h - p.c.shift()).abs(), (p.l - p.c.shift()).abs()], axis=1).max(axis=1)
    macd = ew(p.c, 2 / 13) - ew(p.c, 2 / 27)
    up, down = p.h.diff(), -p.l.diff()
    plus, minus = (100 * ew(x.where((x > y) & (x > 0), 0.0), 1 / 14, 14) / ew(tr, 1 / 14, 14) for x, y in ((up, down), (down, up)))
    obv = ew((np.sign(diff) * p.v).fillna(0).cumsum(), 2 / 21)
    want = {
        "rsi": 100 - 100 / (1 + ew(diff.clip(lower=0), 1 / 14, 14) / ew((-diff).clip(lower=0), 1 / 14, 14)), "macd_hist": macd - ew(macd, 0.2),
        "adx": ew(100 * (plus - minus).abs() / (plus + minus), 1 / 14, 14), "obv_slope": obv.diff(5) / obv.shift(5).replace(0, np.nan), "bbp": (p.c - p.c.rolling(20).mean()) / (2 * p.c.rolling(20).std()),
    }
    for k, s in want.items():
        np.testing.assert_allclose(got[k].astype(float), s, rtol=1e-8, atol=1e-10, err_msg=k)
