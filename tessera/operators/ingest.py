"""Incremental ingestion: what to fetch, what of it may be kept, what a run has sealed, and which harvests are still open."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import bars as b
from tessera.operators import integrity
from tessera.sources.publish import PublishError, Table
from tessera.sources.scratch import cut

#: Fixed value: days of history that a symbol without any bars asks for.
COLD_DAYS = 3650


def windows(universe: DataFrame, stored: DataFrame | None, end: Column, last_session: Column, cold_days: int = COLD_DAYS) -> DataFrame:
    """(sym, start, end, last): what each symbol of the universe still lacks: from the day after its last bar, or
    ``cold_days`` back where it has none. Symbols that reach the last completed session ask for nothing."""
    names = universe.select("sym").where("sym is not null").distinct()
    if stored is None:
        seen = names.withColumn("last", F.lit(None).cast("date"))
    else:
        seen = names.join(stored.groupBy("sym").agg(F.max("d").alias("last")), "sym", "left")
    start = F.coalesce(F.date_add("last", 1), F.date_sub(end, cold_days))
    return seen.where(F.col("last").isNull() | (F.col("last") < last_session)).select("sym", start.alias("start"), end.alias("end"), "last")


def refresh(table: Table, universe: DataFrame, fetch: Callable[[DataFrame], DataFrame], end: Column, last_session: Column) -> DataFrame:
    """One run: asks ``fetch`` for the windows and merges what it answers (rows of the table). An answer outside its window is
    refused, so a vendor that repeats history rewrites none of it. Returns the windows as they were before the run."""
    ask = windows(universe, table.read(), end, last_session)
    got = fetch(ask)
    inside = got.join(ask.select("sym", "start", "end"), "sym").where(F.col("d").between(F.col("start"), F.col("end"))).select(*got.columns)
    table.upsert(inside)
    return ask


def chunks(ranges: DataFrame, saturated: Callable[[DataFrame], DataFrame], least: int = 1) -> DataFrame:
    """Splits ranges (sym, a, z; days, both included) until none is saturated: ``saturated(ranges)`` gives those whose answer
    is at a vendor's limit. Each turn halves those alone, all in one frame, so turns
    grow with the logarithm of the longest range; a range of ``least`` days is kept as it is."""
    done, open_ = None, cut(ranges.select("sym", "a", "z"))
    while True:
        full = saturated(open_).select("sym", "a", "z").distinct().withColumn("_full", F.lit(True))
        marked = cut(open_.join(full, ["sym", "a", "z"], "left").select("sym", "a", "z", (F.col("_full").isNotNull() & (F.datediff("z", "a") >= least)).alias("_split")))
        whole = marked.where("not _split").drop("_split")
        done = whole if done is None else done.union(whole)
        middle = F.date_add("a", F.floor(F.datediff("z", "a") / 2).cast("int"))
        halves = F.explode(F.array(F.struct("a", middle.alias("z")), F.struct(F.date_add(middle, 1).alias("a"), "z")))
        open_ = marked.where("_split").select("sym", halves.alias("r")).select("sym", "r.*")
        if open_.isEmpty():
            return done


def sealed_daily(daily: DataFrame, hourly: DataFrame, through: str) -> DataFrame:
    """Bars (sym, d, o h l c v, bar_close, source) that have closed by ``through``. A symbol whose daily bars (sym, ts, ...) all
    open at UTC midnight keeps them; one with any other is rebuilt from whole days of its hourly bars."""
    bad = b.misaligned(daily).select("sym").distinct()
    own = daily.join(bad, "sym", "left_anti").select("sym", F.to_date("ts").alias("d"), *"ohlcv", F.lit("daily").alias("source"))
    made = b.daily_from_hourly(hourly.join(bad, "sym", "left_semi"), through).select("sym", "d", *"ohlcv", F.lit("hourly").alias("source"))
    both = own.unionByName(made).withColumn("bar_close", F.date_add("d", 1).cast("timestamp"))
    return both.where(F.col("bar_close") <= F.lit(through).cast("timestamp"))


def report(universe: DataFrame, fetched: DataFrame, kept: DataFrame, stored: DataFrame) -> DataFrame:
    """A row for each expected symbol: "ok", "no_sealed_bars" (fetched, but none closed) or "no_data"; the rows of this run and of
    the store, first and last bar, last close, source and content hash."""
    run = kept.groupBy("sym").agg(F.count("*").alias("rows_ingested"), F.max("source").alias("source"))
    held = stored.groupBy("sym").agg(F.count("*").alias("rows_total"), F.min("d").alias("first_bar"), F.max("d").alias("last_bar"), F.max("bar_close").alias("last_bar_close"))
    digest = integrity.tree(stored, ["sym"], F.date_trunc("month", "d"), "d", list("ohlcv")).select("sym", "content_sha256")
    x = universe.select("sym").distinct().join(fetched.select("sym").distinct().withColumn("_fetched", F.lit(True)), "sym", "left")
    x = x.join(run, "sym", "left").join(held.join(digest, "sym"), "sym", "left")
    status = F.when(F.col("_fetched").isNull(), "no_data").when(F.col("rows_ingested").isNull(), "no_sealed_bars").otherwise("ok")
    ok = lambda c: F.when(status == "ok", F.col(c)).alias(c)
    columns = ("source", "rows_total", "first_bar", "last_bar", "last_bar_close", "content_sha256")
    return x.select("sym", status.alias("status"), F.when(status == "ok", F.col("rows_ingested")).otherwise(0).alias("rows_ingested"), *map(ok, columns))


def manifest(report_: DataFrame, dataset: str, generated_at: str, through: str) -> DataFrame:
    """One row that seals a run: the watermark (the least of the symbols' last closes), whether every expected symbol is ok,
    whether a signal may rest on it, a hash of the universe, a root over the symbols' hashes, and the fingerprint of it all."""
    good = F.col("status") == "ok"
    names = integrity.root(report_.withColumn("content_sha256", F.sha2("sym", 256)), "sym").select(F.col("content_sha256").alias("expected_universe_hash"))
    content = integrity.root(report_.where(good), "sym").select(F.col("content_sha256").alias("symbols_hash"))
    one = report_.agg(F.min(F.when(good, F.col("last_bar_close"))).alias("watermark"), F.count("*").alias("n_expected"), F.count(F.when(good, 1)).alias("n_ok"))
    whole = (F.col("n_expected") > 0) & (F.col("n_ok") == F.col("n_expected"))
    x = one.join(F.broadcast(names), F.lit(True), "left").join(F.broadcast(content), F.lit(True), "left")  # one row each
    x = x.withColumns({"dataset_id": F.lit(dataset), "generated_at": F.lit(generated_at).cast("timestamp"), "fetched_through": F.lit(through).cast("timestamp"), "universe_complete": whole, "signal_eligible": whole & F.col("watermark").isNotNull()})
    return integrity.fingerprinted(x)


# ---- harvests that can be broken off and taken up again


def open_symbols(universe: DataFrame, harvest: DataFrame | None) -> DataFrame:
    """Symbols that are not done. Done means a marker row (``done`` true) is there and the number of records it states."""
    names = universe.select(F.upper(F.trim("sym")).alias("sym")).where("sym is not null").distinct()
    if harvest is None:
        return names
    marked = harvest.groupBy("sym").agg(F.max(F.when(F.col("done"), F.col("n_records"))).alias("stated"), F.count(F.when(~F.col("done"), 1)).alias("there"))
    return names.join(marked.where("stated = there").select("sym"), "sym", "left_anti")


def harvested(records: DataFrame, answered: DataFrame, key: str) -> DataFrame:
    """Rows of a harvest: the records of the symbols that answered, and for each such symbol a marker that states their number,
    which may be none. ``key`` names a record within its symbol."""
    counts = answered.select("sym").distinct().join(records.groupBy("sym").agg(F.count("*").alias("n")), "sym", "left")
    marks = counts.select("sym", F.lit("").alias(key), F.lit(True).alias("done"), F.coalesce("n", F.lit(0)).cast("long").alias("n_records"))
    return records.withColumn("done", F.lit(False)).unionByName(marks, allowMissingColumns=True)


def take_up(table: Table, universe: DataFrame, fetch: Callable[[DataFrame], tuple[DataFrame, DataFrame]], key: str, buckets: int, floor: float = 0.0) -> int:
    """One run of a harvest into a table by ``bucket`` (a hash of the symbol): asks for the open symbols and replaces whatever an
    earlier run has left of those that answer. ``fetch(symbols)`` gives (records, symbols that answered). Fewer answers than
    ``floor`` of what was asked stop the run before anything is published. Returns the number of symbols still open."""
    old = table.read()
    ask = open_symbols(universe, old)
    records, answered = fetch(ask)
    asked, got = ask.count(), answered.join(ask, "sym", "left_semi").distinct().count()
    if asked and got < floor * asked:
        raise PublishError(f"{got} of {asked} symbols answered, fewer than {floor:.0%}; nothing was published")
    new = harvested(records, answered, key).withColumn("bucket", F.pmod(F.xxhash64("sym"), F.lit(buckets)).cast("int"))
    if old is not None:
        touched = answered.select(F.pmod(F.xxhash64("sym"), F.lit(buckets)).cast("int").alias("bucket")).distinct()
        kept = old.join(F.broadcast(touched), "bucket", "left_semi").join(answered.select("sym").distinct(), "sym", "left_anti")  # at most ``buckets`` numbers
        new = kept.select(*new.columns).unionByName(new)
    table.publish(new)
    return asked - got


def missing_months(rows: DataFrame, day: str, there: list[str], overwrite: bool = False) -> DataFrame:
    """Rows with their month (first day, as text) whose month is not among the partitions that exist."""
    x = rows.where(F.col(day).isNotNull()).withColumn("month", F.date_format(F.trunc(day, "month"), "yyyy-MM-dd"))
    return x if overwrite or not there else x.where(~F.col("month").isin(there))
