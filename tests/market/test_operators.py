"""Small hand-made cases: boundaries, ties, nulls, causality; whole queries are held against SQL in test_oracles.py."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.functions import scalars
from tessera.functions import windows as w
from tessera.operators import asof, bars, factors, fundamentals, labels, normalize, rolling, splits, technical
from tessera.plans import more_queries  # noqa: F401  registers its queries
from tessera.plans.queries import QUERIES
from tessera.sources import tables
from tessera.streaming.bars import daily_stream

D0 = dt.date(2024, 1, 1)
day = lambda n: D0 + dt.timedelta(days=n)


def walk(n, sym="A", seed=1):
    rng = np.random.default_rng(seed)
    c = 50 + np.cumsum(rng.normal(0, 1, n))
    o, v = c + rng.normal(0, 0.3, n), rng.integers(0, 500, n)
    return [(sym, day(i), float(o[i]), float(max(o[i], c[i]) + 0.5), float(min(o[i], c[i]) - 0.5), float(c[i]), float(v[i])) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "sym string, d date, o double, h double, l double, c double, v double")


def test_158_features_and_warm_up(spark):
    names = rolling.feature_names()
    assert len(names) == 158 == len(set(names))
    out = rolling.features(frame(spark, walk(80)))
    assert out.columns == ["sym", "d", *names]
    rows = out.orderBy("d").collect()
    first = lambda c: next(i for i, r in enumerate(rows) if r[c] is not None)
    assert (first("MA20"), first("ROC20"), first("CNTP5"), first("SUMP5"), first("CORD5")) == (19, 20, 4, 5, 5)
    served = rolling.features(frame(spark, walk(80)), "serve")
    assert served.count() == 11


def test_features_do_not_look_ahead(spark):
    rows = walk(75)
    changed = rows[:74] + [("A", day(74), 1.0, 900.0, 0.5, 700.0, 9e6)]
    a, b = (rolling.features(frame(spark, x)).where(F.col("d") < day(74)).orderBy("d").collect() for x in (rows, changed))
    assert a == b


def test_ties_and_constant_windows(spark):
    rows = [("A", day(i), c, c, c, c, 10.0) for i, c in enumerate([1.0, 2.0, 2.0, 3.0, 2.0, 2.0])]
    r = rolling.features(frame(spark, rows), only={"RANK", "RSQR", "IMAX", "CORR"}, sizes=(5,)).orderBy("d").collect()[-1]
    assert r.RANK5 == pytest.approx((0 + 2.5) / 5) and r.IMAX5 == pytest.approx(2 / 5) and r.CORR5 is None
    x = frame(spark, rows).select("sym", "d", w.rank_top(F.col("c"), 5).alias("r")).orderBy("d").collect()[-1]
    assert x.r == pytest.approx(4 / 5)
    flat = [("A", day(i), 1.0, 1.0, 1.0, 1.0, 0.0) for i in range(5)]
    assert rolling.features(frame(spark, flat), only={"RSQR"}, sizes=(5,)).orderBy("d").collect()[-1].RSQR5 is None


def test_asof_bounds(spark):
    left = spark.createDataFrame([("A", day(i)) for i in (0, 1, 2, 9)] + [("B", day(1))], "sym string, d date")
    right = spark.createDataFrame([("A", day(1), 1.0), ("A", day(2), 2.0), ("A", day(2), 3.0), ("B", day(5), 9.0)], "sym string, d date, x double")
    get = lambda **k: [r.x for r in asof.asof_join(left, right, **k).orderBy("sym", "d").collect()]
    assert get() == [None, 1.0, 3.0, 3.0, None]
    assert get(exact=False) == [None, None, 1.0, 3.0, None]
    assert get(days=6) == [None, 1.0, 3.0, None, None]
    assert get(rows=0) == [None, 1.0, 3.0, None, None]
    assert get(rows=1) == [None, 1.0, 3.0, 3.0, None]


def test_calendar_label_needs_a_real_last_bar(spark):
    rows = [(s, day(i), 1.0, 1.0, 1.0, float(10 + i * k), 1.0) for s, k in (("M", 1), ("A", 2)) for i in (0, 1, 3, 4)]
    out = {(r.sym, r.d): r for r in labels.calendar_forward(frame(spark, rows), (1,), "M").collect()}
    assert out["A", day(1)].fwd_1d is None and out["A", day(1)].available_after_1d is None
    assert out["A", D0].fwd_1d_excess == pytest.approx(0.2 - 0.1) and out["M", D0].fwd_1d_excess is None
    assert out["A", D0].available_after_1d == day(2)


def test_train_statistics_come_from_the_training_rows(spark):
    df = spark.createDataFrame([("A", day(i), float(i)) for i in range(10)] + [("A", day(10), None), ("A", day(11), 1e9)], "sym string, d date, x double")
    out = [r.x for r in normalize.train_clip_z(df, ["x"], F.col("d") < day(10), tails=0.0).orderBy("d").collect()]
    sd = np.std(np.arange(10.0), ddof=1)
    assert out[:10] == pytest.approx(list((np.arange(10) - 4.5) / sd)) and out[10] == 0 and out[11] == pytest.approx(4.5 / sd)


def test_undated_filing_wins_and_fallback_lag(spark):
    rows = [("A", D0, dt.datetime(2024, 2, 1), "c1", 1.0, 1), ("A", D0, None, "c1", 2.0, 2), ("B", D0, None, "c1", 3.0, 3)]
    facts = spark.createDataFrame(rows, "sym string, period_end date, filed timestamp, concept string, val double, event_id long")
    out = {r.sym: r for r in fundamentals.latest_pivot(facts, ["c1", "c2"]).collect()}
    assert out["A"].c1 == 2.0 and out["B"].available == day(60) and out["B"].source == "fallback" and out["B"].c2 is None


def test_trailing_year_with_a_derived_quarter(spark):
    q = [("A", dt.date(2023, a, 1), dt.date(2023, b, e), float(v)) for a, b, e, v in ((1, 3, 31, 1), (4, 6, 30, 2), (7, 9, 30, 3))]
    quarters = spark.createDataFrame(q, "sym string, start date, end date, val double")
    annual = spark.createDataFrame([("A", dt.date(2023, 1, 1), dt.date(2023, 12, 31), 10.0)], "sym string, start date, end date, val double")
    fourth = [r for r in fundamentals.derive_fourth(quarters, annual).collect() if r.end == dt.date(2023, 12, 31)]
    assert [r.val for r in fourth] == [4.0]
    assert [(r.end, r.ttm) for r in fundamentals.trailing_year(quarters, annual).collect()] == [(dt.date(2023, 12, 31), 10.0)]


def test_exponential_means_match_pandas(spark):
    x = [1.0, None, 3.0, 4.0, None, None, 2.0, 5.0]
    df = spark.createDataFrame([("A", day(i), v) for i, v in enumerate(x)], "sym string, d date, x double")
    got = [r.e for r in technical.ewm(df, e=("x", 0.3)).orderBy("d").collect()]
    assert got == pytest.approx(pd.Series(x).ewm(alpha=0.3, adjust=False).mean().tolist())
    c = pd.Series([r[5] for r in walk(60)])
    up, down = c.diff().clip(lower=0), (-c.diff()).clip(lower=0)
    rs = up.ewm(alpha=1 / 14, adjust=False, min_periods=14).mean() / down.ewm(alpha=1 / 14, adjust=False, min_periods=14).mean()
    got = [r.rsi for r in technical.rsi(frame(spark, walk(60))).orderBy("d").collect()]
    assert [x for x in got if x is not None] == pytest.approx((100 - 100 / (1 + rs)).dropna().tolist())


def test_residual_deviation_is_least_squares(spark):
    rng = np.random.default_rng(4)
    n = 70
    rm, z = rng.normal(0, 1, n), rng.normal(0, 1, n)
    r = 0.5 * rm - 0.2 * z + rng.normal(0, 0.3, n)
    df = spark.createDataFrame([("A", day(i), float(r[i]), float(rm[i]), float(z[i])) for i in range(n)], "sym string, d date, r double, rm double, z double")
    got = df.select("d", factors.residual_deviation(60).alias("x")).orderBy("d").collect()[-1].x
    a = np.column_stack([np.ones(60), rm[-60:], z[-60:]])
    res = r[-60:] - a @ np.linalg.lstsq(a, r[-60:], rcond=None)[0]
    assert got == pytest.approx(res.std(ddof=1))


def test_hourly_days_must_be_whole_and_sealed(spark):
    at = lambda d, h: dt.datetime(2024, 1, d, h)
    rows = [("A", at(1, h), float(h), h + 0.5, h - 0.5, h + 0.25, 1) for h in range(24)] + [("A", at(2, h), 1.0, 1.0, 1.0, 1.0, 1) for h in range(23)] + [("A", at(2, 5), 1.0, 1.0, 1.0, 1.0, 1)]
    hours = spark.createDataFrame(rows, "sym string, ts timestamp, o double, h double, l double, c double, v long")
    out = bars.daily_from_hourly(hours).collect()
    assert [tuple(r) for r in out] == [("A", D0, 0.0, 23.5, -0.5, 23.25, 24, 24)]
    assert bars.daily_from_hourly(hours, "2024-01-01 12:00:00").count() == 0


def test_measured_factor_steps(spark):
    rows = [("A", day(i), (200.0 if i < 30 else 100.0) * (1 + 0.001 * (i == 10)), 100.0) for i in range(60)]
    prices = spark.createDataFrame(rows, "sym string, d date, raw double, adjusted double")
    none = spark.createDataFrame([], "sym string, d date, ratio double")
    out = splits.measured(prices, none).orderBy("d").collect()
    assert out[0].factor == pytest.approx(2) and out[29].factor == pytest.approx(2) and out[30].factor == pytest.approx(1) and out[0].ok
    blip = spark.createDataFrame([("A", day(i), 150.0 if 5 <= i < 8 else 100.0, 100.0) for i in range(60)], "sym string, d date, raw double, adjusted double")
    assert {round(r.factor, 6) for r in splits.measured(blip, none).collect()} == {1.0} and not splits.measured(blip, none).first().ok


def test_factor_of_many_splits_is_their_product(spark):
    first = dt.date(2000, 1, 1)
    ratios = [0.5] * 45 + [2.0] * 40  # the earliest day stands before all of them
    rows = [("A", first + dt.timedelta(k + 1), r) for k, r in enumerate(ratios)]
    days = spark.createDataFrame([("A", first + dt.timedelta(k)) for k in range(86)], "sym string, d date")
    out = splits.reconstructed(days, spark.createDataFrame(rows, "sym string, d date, ratio double")).orderBy("d").collect()
    assert [r.factor for r in out] == [math.prod(ratios[k:]) for k in range(86)]


def test_scalars(spark):
    df = spark.createDataFrame([(1.0, 0.0, "btc/usd ", "BRK.B", "AAPL  240119C00150000"), (1.0, -2.0, "x", "ABC", "bad"), (1e9, 1.0, None, None, None)], "a double, b double, p string, s string, o string")
    got = df.select(scalars.safe_ratio(F.col("a"), F.col("b")).alias("r"), scalars.pair_slug(F.col("p")).alias("p"), scalars.class_suffix(F.col("s")).alias("s"), scalars.option_symbol(F.col("o")).alias("o")).collect()
    assert [r.r for r in got] == [None, -0.5, None] and [r.p for r in got] == ["BTC-USD", None, None] and [r.s for r in got] == ["BRK-B", "ABC", None]
    assert tuple(got[0].o) == ("AAPL", dt.date(2024, 1, 19), "C", 150.0) and got[1].o.root is None
    days = spark.range(14).select(F.date_add(F.lit(D0), F.col("id").cast("int")).alias("d"))
    for n in (-20, -3, 0, 1, 5, 7):
        for r in days.select("d", scalars.business_days(F.col("d"), n).alias("b")).collect():
            assert r.b == np.busday_offset(r.d, n, roll="backward").astype(object)


def test_upsert_and_refresh_order(spark):
    old = spark.createDataFrame([("A", D0, 1.0), ("A", day(1), 2.0)], "sym string, d date, x double")
    new = spark.createDataFrame([("A", day(1), 3.0), ("B", D0, 4.0)], "sym string, d date, x double")
    assert sorted((r.sym, r.x) for r in tables.upsert(old, new, ["sym", "d"]).collect()) == [("A", 1.0), ("A", 3.0), ("B", 4.0)]
    names = spark.createDataFrame([("A",), ("B",), ("C",)], "sym string")
    assert [r.sym for r in tables.newest_first(old.unionByName(new), names, 2).collect()] == ["C", "B"]


def test_content_hash_ignores_file_order(spark):
    a = frame(spark, walk(20))
    assert bars.content_hash(a).collect() == bars.content_hash(a.orderBy(F.rand(3)).repartition(3)).collect()
    assert bars.content_hash(a).first().content_sha256 != bars.content_hash(a.withColumn("c", F.col("c") + 1)).first().content_sha256


def test_day_bars_from_a_stream(spark, tmp_path):
    rows = [("A", dt.datetime(2024, 1, 1, h), h, float(h)) for h in (3, 1, 2, 1)] + [("A", dt.datetime(2024, 1, 2, 5), 50, 9.0), ("A", dt.datetime(2024, 1, 5), 60, 1.0)]
    schema = "sym string, ts timestamp, id long, price double"
    for k, part in enumerate((rows[:5], rows[5:])):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / "in" / str(k)))
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = daily_stream(stream).writeStream.format("memory").queryName("day_bars").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = [tuple(r) for r in spark.table("day_bars").orderBy("d").collect()]
    assert got[0] == ("A", D0, 1.0, 3.0, 1.0, 3.0, 3) and all(not math.isnan(r[2]) for r in got)


def test_registered_upsert_merges_two_overlapping_sides(spark, monkeypatch):
    sides = []
    upsert = tables.upsert
    monkeypatch.setattr(tables, "upsert", lambda old, new, keys: (sides.extend((old, new)), upsert(old, new, keys))[1])
    got = {(r.sym, r.d): r.seq for r in QUERIES["upsert_keep_last"](spark, "/root/testdata/sf0.001").collect()}
    old, new = ({(r.sym, r.d): r.seq for r in x.collect()} for x in sides)
    assert set(old) - set(new) and set(new) - set(old) and set(old) & set(new)
    assert got == old | new


def test_leaks_in_the_daily_panel_are_counted(spark, monkeypatch):
    run = lambda: QUERIES["pit_violations"](spark, "/root/testdata/sf0.001").first()
    clean, to_daily = run(), fundamentals.to_daily
    monkeypatch.setattr(fundamentals, "to_daily", lambda carried, days: to_daily(carried.withColumn("d", F.date_sub("d", 1)), days))
    leaky = run()  # every row is used a day before it is known
    assert clean.used_before_known == 0 < leaky.used_before_known and clean.n_rows == leaky.n_rows
    rows = [("A", D0, day(3), 1.0, None), ("A", day(1), day(5), None, 2.0)]
    wide = spark.createDataFrame(rows, "sym string, period_end date, available date, c1 double, c2 double")
    last = fundamentals.carry_forward(wide, ["c1", "c2"], known=True).orderBy("d").collect()[-1]
    assert (last.c1, last.c1_known, last.c2, last.c2_known) == (1.0, day(3), 2.0, day(5))
