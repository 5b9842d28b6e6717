import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tessera.operators import ingest, integrity
from tessera.sources import seam
from tessera.sources.publish import PublishError, Table

day = dt.date.fromisoformat
SCHEMA = "sym string, d date, c double, month string"


def bars(spark, rows):
    return spark.createDataFrame([(s, day(d), c, d[:7]) for s, d, c in rows], SCHEMA)


def rows_of(table):
    return sorted((r.sym, str(r.d), r.c) for r in table.read().collect())


@pytest.fixture
def table(spark, tmp_path):
    return Table(spark, str(tmp_path / "bars"), "month", ["sym", "d"])


def test_two_runs_give_the_table_of_one(spark, table):
    assert table.read() is None and table.parts() == []
    new = bars(spark, [("a", "2020-01-01", 1.0), ("a", "2020-02-01", 2.0), ("b", "2020-02-03", 3.0)])
    assert table.upsert(new) == ["month=2020-01", "month=2020-02"]
    once = rows_of(table)
    table.upsert(new)
    assert rows_of(table) == once and len(once) == 3
    kept = {p.name: p.stat().st_mtime_ns for p in (Path(table.path) / "month=2020-01").iterdir()}
    table.upsert(bars(spark, [("b", "2020-02-03", 9.0), ("c", "2020-02-04", 4.0), ("c", "2020-03-01", 5.0)]))
    assert rows_of(table) == [("a", "2020-01-01", 1.0), ("a", "2020-02-01", 2.0), ("b", "2020-02-03", 9.0), ("c", "2020-02-04", 4.0), ("c", "2020-03-01", 5.0)]
    assert {p.name: p.stat().st_mtime_ns for p in (Path(table.path) / "month=2020-01").iterdir()} == kept  # an untouched partition
    assert table.upsert(bars(spark, [])) == [] and len(rows_of(table)) == 5


def test_a_run_broken_before_its_commit_leaves_the_old_table(spark, table, monkeypatch):
    table.upsert(bars(spark, [("a", "2020-01-01", 1.0)]))

    def lost(self):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Table, "_commit", lost)
        with pytest.raises(KeyboardInterrupt):
            table.upsert(bars(spark, [("a", "2020-01-01", 2.0), ("b", "2020-02-01", 2.0)]))
    assert rows_of(table) == [("a", "2020-01-01", 1.0)] and (Path(table.path) / "_next").exists()
    again = Table(spark, table.path, "month", ["sym", "d"])
    assert rows_of(again) == [("a", "2020-01-01", 1.0)] and not (Path(table.path) / "_next").exists()
    again.upsert(bars(spark, [("a", "2020-01-01", 2.0), ("b", "2020-02-01", 2.0)]))
    assert rows_of(again) == [("a", "2020-01-01", 2.0), ("b", "2020-02-01", 2.0)]


def test_a_run_broken_after_its_commit_is_carried_out(spark, table, monkeypatch):
    table.upsert(bars(spark, [("a", "2020-01-01", 1.0), ("a", "2020-02-01", 1.0)]))
    move = Table._move

    def half(self, names):
        self._fs.delete(self._at(names[0]), True)
        self._fs.rename(self._at("_next", names[0]), self._at(names[0]))
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Table, "_move", half)
        with pytest.raises(KeyboardInterrupt):
            table.upsert(bars(spark, [("a", "2020-01-01", 2.0), ("a", "2020-02-01", 2.0), ("b", "2020-03-01", 2.0)]))
    assert Table._move is move
    again = Table(spark, table.path, "month", ["sym", "d"])
    assert rows_of(again) == [("a", "2020-01-01", 2.0), ("a", "2020-02-01", 2.0), ("b", "2020-03-01", 2.0)]
    assert not [p for p in Path(table.path).iterdir() if p.name.startswith("_")]


def test_what_fails_its_check_is_not_published(spark, table):
    table.upsert(bars(spark, [("a", "2020-01-01", 1.0)]))
    with pytest.raises(PublishError, match="occurs twice"):
        table.publish(bars(spark, [("a", "2020-01-01", 2.0), ("a", "2020-01-01", 3.0)]))
    with pytest.raises(PublishError, match="negative"):
        table.upsert(bars(spark, [("b", "2020-01-01", -1.0)]), lambda x: "negative" if x.where("c < 0").count() else None)
    assert rows_of(table) == [("a", "2020-01-01", 1.0)]


def test_refresh_asks_for_what_is_missing(spark, table):
    table.upsert(bars(spark, [("a", "2020-01-10", 1.0), ("b", "2020-01-08", 1.0)]))
    universe = spark.createDataFrame([("a",), ("b",), ("c",), ("b",), (None,)], "sym string")
    asked = []

    def fetch(windows):
        asked.append(sorted((r.sym, str(r.start), str(r.end)) for r in windows.collect()))
        return bars(spark, [("b", "2020-01-08", 99.0), ("b", "2020-01-09", 2.0), ("c", "2020-01-10", 3.0), ("c", "2020-01-12", 3.0), ("a", "2020-01-10", 99.0)])

    run = lambda: ingest.refresh(table, universe, fetch, F.lit("2020-01-10").cast("date"), F.lit("2020-01-10").cast("date"))
    run()
    assert asked == [[("b", "2020-01-09", "2020-01-10"), ("c", "2010-01-12", "2020-01-10")]]
    assert rows_of(table) == [("a", "2020-01-10", 1.0), ("b", "2020-01-08", 1.0), ("b", "2020-01-09", 2.0), ("c", "2020-01-10", 3.0)]
    run()
    assert asked[1] == [("b", "2020-01-10", "2020-01-10")] and len(rows_of(table)) == 4


def test_a_harvest_is_taken_up_where_it_broke_off(spark, tmp_path):
    """Symbols without an answer stay open, half-written ones are replaced, one with no records is done."""
    table = Table(spark, str(tmp_path / "h"), "bucket", ["sym", "key", "done"])
    universe = spark.createDataFrame([(x,) for x in "abcd"], "sym string")
    calls = []

    def fetch(names, fail=()):
        got = sorted(r.sym for r in names.collect())
        calls.append(got)
        answered = spark.createDataFrame([(x,) for x in got if x not in fail], "sym string")
        records = answered.where("sym <> 'D'").select("sym", F.explode(F.array(F.lit("k1"), F.lit("k2"))).alias("key"), F.lit(1.0).alias("val"))
        return records, answered

    with pytest.raises(PublishError, match="1 of 4"):
        ingest.take_up(table, universe, lambda x: fetch(x, "ABC"), "key", 3, 0.5)
    assert table.read() is None
    assert ingest.take_up(table, universe, lambda x: fetch(x, "BC"), "key", 3, 0.5) == 2
    half = table.read().where("sym = 'A' and key = 'k1'")
    assert half.count() == 1
    broken = table.read().where("not (sym = 'A' and key = 'k1')").union(spark.createDataFrame([("B", "k1", 7.0, False, None, 0)], table.read().schema))
    table.publish(spark.createDataFrame(broken.collect(), broken.schema))
    assert ingest.take_up(table, universe, fetch, "key", 3) == 0
    assert ingest.take_up(table, universe, fetch, "key", 3) == 0
    assert calls == [list("ABCD"), list("ABCD"), list("ABC"), []]
    got = sorted((r.sym, r.key, r.val, r.done, r.n_records) for r in table.read().collect())
    assert got == sorted([(s, k, 1.0, False, None) for s in "ABC" for k in ("k1", "k2")] + [(s, "", None, True, 2) for s in "ABC"] + [("D", "", None, True, 0)])


def test_chunks_are_below_the_limit_and_gapless(spark):
    ranges = spark.createDataFrame([("a", day("2020-01-01"), day("2020-03-01")), ("b", day("2020-01-01"), day("2020-01-01")), ("c", day("2020-01-01"), day("2020-01-02"))], "sym string, a date, z date")
    weight = lambda r: (r.z - r.a).days + 1 + (50 if r.a <= day("2020-02-02") <= r.z and r.sym == "a" else 0)
    out = ingest.chunks(ranges, lambda x: spark.createDataFrame([tuple(r) for r in x.collect() if weight(r) > 9 or r.sym == "b"], x.schema)).collect()
    by = {s: sorted((r.a, r.z) for r in out if r.sym == s) for s in "abc"}
    assert by["b"] == [(day("2020-01-01"),) * 2] and by["c"] == [(day("2020-01-01"), day("2020-01-02"))]
    assert all(weight(r) <= 9 or r.a == r.z for r in out)
    assert by["a"][0][0] == day("2020-01-01") and by["a"][-1][1] == day("2020-03-01") and all(q[0] - p[1] == dt.timedelta(days=1) for p, q in zip(by["a"], by["a"][1:]))


def test_one_changed_byte_names_its_partition(spark, table):
    table.upsert(bars(spark, [("a", "2020-01-01", 1.0), ("a", "2020-02-01", 2.0)]))
    sealed = {r.file: (r.partition, r.sha256) for r in integrity.file_hashes(spark, table.path).collect()}
    assert {p for p, _ in sealed.values()} == {"month=2020-01", "month=2020-02"}
    (file,) = (Path(table.path) / "month=2020-02").glob("*.parquet")
    data = bytearray(file.read_bytes())
    data[len(data) // 2] ^= 1
    file.write_bytes(data)
    file.with_name(f".{file.name}.crc").unlink()  # the local file system's own check
    now = {r.file: r.sha256 for r in integrity.file_hashes(spark, table.path).collect()}
    assert {sealed[f][0] for f in now if now[f] != sealed[f][1]} == {"month=2020-02"}


def test_each_reason_against_a_signal(spark):
    rep = spark.createDataFrame([("a", "ok", dt.datetime(2020, 1, 2), "h1"), ("b", "ok", dt.datetime(2020, 1, 2), "h2")], "sym string, status string, last_bar_close timestamp, content_sha256 string")
    actual = spark.createDataFrame([("a", "h1"), ("b", "other")], "sym string, content_sha256 string")
    made = lambda r=rep, at="2020-01-02 00:14:59": ingest.manifest(r, "x", at, "2020-01-02")
    ask = lambda m, r=rep, session="2020-01-02": {x.sym: x.problem for x in integrity.signal_problems(m, r, actual, session).collect()}
    assert ask(made()) == {"a": None, "b": "content differs from the sealed one"}
    assert set(ask(made().withColumn("dataset_id", F.lit("y"))).values()) == {"fingerprint"}
    part = rep.withColumn("status", F.when(F.col("sym") == "b", "no_data").otherwise("ok"))
    assert set(ask(made(part), part).values()) == {"universe incomplete"}
    assert set(ask(made(), session="2020-01-03").values()) == {"another session's watermark"}
    assert set(ask(made(at="2020-01-02 00:15:00")).values()) == {"made outside the window"} == set(ask(made(at="2020-01-01 23:59:59")).values())
    none = integrity.fingerprinted(made().withColumn("watermark", F.lit(None).cast("timestamp")))
    assert set(ask(none).values()) == {"no watermark"}
    assert integrity.genuine(made()).first().genuine


def count_days(symbol, start, end, options):
    for k in range((end - start).days + 1):
        yield symbol, start + dt.timedelta(days=k)


count_days.latest = lambda options: day(Path(options["clock"]).read_text())


def test_the_seam_as_batch_and_stream(spark, tmp_path):
    seam.register(spark)
    clock = tmp_path / "clock"
    options = {"function": "tests.market.test_ingest:count_days", "schema": "sym string, d date", "names": "a, B,a", "start": "2020-01-01", "days": "3", "clock": str(clock)}
    df = spark.read.format("vendor").options(**options, end="2020-01-07").load()
    assert df.rdd.getNumPartitions() == 6
    assert sorted((r.sym, r.d.day) for r in df.collect()) == [(s, k) for s in "AB" for k in range(1, 8)]
    stream = lambda: spark.readStream.format("vendor").options(**options).load().writeStream.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).format("parquet").start(str(tmp_path / "out")).awaitTermination()
    for today, n in (("2020-01-02", 4), ("2020-01-05", 10), ("2020-01-05", 10)):
        clock.write_text(today)
        stream()
        assert spark.read.parquet(str(tmp_path / "out")).distinct().count() == n == spark.read.parquet(str(tmp_path / "out")).count()
