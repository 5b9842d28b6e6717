import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators import corpus, equity, macro

day = dt.date.fromisoformat
COLUMNS = corpus.contract(["f"], family=["g"])
TYPES = "sym string, d date, f double, fwd_5d_excess double, fwd_20d_excess double, fwd_60d_excess double, split string, g double"


def panel(spark, *rows):
    return spark.createDataFrame([(s, day(d), 1.0, label, 0.1, 0.2, "train", 2.0) for s, d, label in rows], TYPES)


def watch(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "sym string")


def test_the_contract_has_178_columns():
    whole = corpus.contract()
    assert len(whole) == 178 and whole[:3] == ["sym", "d", "KMID"] and whole[160:164] == [*equity.LABELS, "split"] and whole[-1] == "n_articles_log"


def test_the_corpus_keeps_listed_rows_with_labels(spark):
    p = panel(spark, ("a", "2020-01-02", 0.5), ("A", "2020-01-01", None), ("A", "2020-01-03", float("nan")), ("B", "2020-01-01", 0.1))
    got = corpus.training_corpus(p, watch(spark, "A", "a", "z"), COLUMNS)
    assert got.columns == COLUMNS and [(r.sym, str(r.d)) for r in got.collect()] == [("A", "2020-01-02")]
    r = corpus.corpus_report(p, watch(spark, "A", "a", "z"), COLUMNS).first()
    assert (r.n_rows, r.n_symbols, r.n_columns, r.n_dropped, r.absent) == (1, 1, 8, 2, "Z")


def test_the_corpus_fails_closed(spark):
    p = panel(spark, ("A", "2020-01-02", 0.5))
    with pytest.raises(ValueError, match="missing: g"):
        corpus.training_corpus(p.drop("g"), watch(spark, "A"), COLUMNS)
    with pytest.raises(ValueError, match="beyond the contract: more"):
        corpus.training_corpus(p.withColumn("more", F.lit(1)), watch(spark, "A"), COLUMNS)
    assert corpus.training_corpus(p.withColumn("more", F.lit(1)), watch(spark, "A"), COLUMNS, exact=False).columns == COLUMNS
    with pytest.raises(ValueError, match="labels beyond the contract: x"):
        corpus.training_corpus(p, watch(spark, "A"), COLUMNS, ["x"])
    with pytest.raises(Exception, match="rows of one key"):
        corpus.training_corpus(p.union(p), watch(spark, "A"), COLUMNS).select("f").collect()
    for names, q, why in (((), p, "list is empty"), (("B",), p, "no listed symbol"), (("A",), panel(spark, ("A", "2020-01-02", None)), "has its labels")):
        with pytest.raises(Exception, match=why):
            corpus.corpus_report(q, watch(spark, *names), COLUMNS).collect()


def test_raw_labels_reach_the_last_bar(spark):
    dates = [f"2020-01-0{k}" for k in range(1, 7)]
    bars = spark.createDataFrame([("a", day(x), 2.0**k) for k, x in enumerate(dates)], "sym string, d date, c double")
    market = spark.createDataFrame([(day(x), 1.0 + k) for k, x in enumerate(dates)], "d date, c double")
    p, today = panel(spark, ("A", dates[0], None), ("A", dates[1], 0.1), ("B", dates[0], 0.1)), F.lit("2020-02-01").cast("date")
    run = lambda extend, **k: corpus.raw_label_table(k.get("p", p), k.get("bars", bars), market, k.get("today", today), COLUMNS, rows=2, extend=extend)
    got = {(r.sym, r.d.day): (r.fwd_60d_excess_raw, r.f) for r in run(True).collect()}
    want = {("A", k + 1): (pytest.approx(3.0 - ((k + 3) / (k + 1) - 1)) if k < 4 else None, 1.0 if k < 2 else None) for k in range(6)} | {("B", 1): (None, 1.0)}
    assert got == want and run(False).count() == 3
    r = corpus.raw_label_report(run(True), p, bars).first()
    assert (r.n_rows, r.n_panel, r.n_extended, r.n_labelled, r.n_unlabelled, r.unpriced, r.last_labelled) == (7, 3, 4, 4, 3, "B", day("2020-01-04"))
    early = F.lit("2020-01-01").cast("date")
    for why, k in (("(panel|bars|market) after today", {"today": early}), ("(bars|market) after today", {"today": early, "p": p.where("f < 0")}), ("rows of one key", {"bars": bars.union(bars)})):
        with pytest.raises(Exception, match=why):
            run(True, **k).collect()
    with pytest.raises(Exception, match="no row has a raw label"):
        corpus.raw_label_report(run(False, p=p.where("sym = 'B'")), p, bars).collect()
    with pytest.raises(ValueError, match="already"):
        run(False, p=p.withColumn("fwd_60d_excess_raw", F.lit(0.0)))


def test_releases_are_late_by_rows_and_gaps_are_judged(spark):
    days = [day("2020-01-01") + dt.timedelta(k) for k in range(12)]
    calendar = spark.createDataFrame([(x,) for x in days], "d date")
    series = spark.createDataFrame([("A", days[0], 1.0), ("A", days[4], 3.0), ("B", days[9], 5.0)], "sym string, d date, c double")
    got = {(r.sym, r.d): r.c for r in macro.released(series, calendar, {"A": 2, "B": 0}).collect()}
    assert [got["A", x] for x in days] == [None] * 2 + [1.0] * 4 + [3.0] * 6 and [got["B", x] for x in days] == [None] * 9 + [5.0] * 3
    scores = macro.rate_scores(series, calendar, {"A": 2, "B": 0}, F.lit("2020-01-09").cast("date"), 2)
    v = {r.sym: (r.used, r.share, r.reason) for r in macro.verdicts(scores, spark.createDataFrame([("A",), ("B",), ("C",)], "sym string")).collect()}
    assert v == {"A": (True, 1.0, None), "B": (False, 0.375, "coverage"), "C": (False, None, "no_rows")}
