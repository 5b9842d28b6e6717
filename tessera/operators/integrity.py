"""Content hashes as trees, fingerprints, and what a manifest must hold before a signal may rest on it.

No hash gathers a symbol's rows: rows are hashed one by one, the hashes of a small leaf (a month of a symbol) together, then
the leaves of a symbol, then symbols by the first two digits of their hash, then those 256.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _joined(x: str) -> Column:
    return F.sha2(F.array_join(F.array_sort(F.collect_list(x)), "\n"), 256)


def row_hash(order: str, columns: list[str], scale: int = 1_000_000) -> Column:
    """SHA-256 of a row's text. Doubles are scaled to integers, as engines print them differently; null is empty."""
    text = [F.coalesce(F.round(F.col(c) * scale).cast("long").cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws("|", F.col(order).cast("string"), *text), 256)


def leaves(df: DataFrame, by: list[str], leaf: Column, order: str, columns: list[str], scale: int = 1_000_000) -> DataFrame:
    """(by..., leaf, n, leaf_sha256): the lowest level, a hash over the sorted row hashes of each leaf."""
    rows = df.select(*by, leaf.cast("date").alias("leaf"), row_hash(order, columns, scale).alias("r"))
    return rows.groupBy(*by, "leaf").agg(_joined("r").alias("leaf_sha256"), F.count("*").alias("n"))


def tree(df: DataFrame, by: list[str], leaf: Column, order: str, columns: list[str], scale: int = 1_000_000) -> DataFrame:
    """(by..., n, content_sha256): a hash over the sorted leaves of each group, whatever files its rows came from."""
    x = leaves(df, by, leaf, order, columns, scale)
    named = x.withColumn("named", F.concat_ws("=", F.col("leaf").cast("string"), "leaf_sha256"))
    return named.groupBy(*by).agg(_joined("named").alias("content_sha256"), F.sum("n").alias("n"))


def root(groups: DataFrame, by: str) -> DataFrame:
    """One row: a hash over all groups' (name, content_sha256), by way of 256 buckets."""
    named = groups.select(F.concat_ws("=", F.col(by).cast("string"), "content_sha256").alias("named"))
    buckets = named.groupBy(F.substring(F.sha2("named", 256), 1, 2).alias("bucket")).agg(_joined("named").alias("h"))
    return buckets.select(F.concat_ws("=", "bucket", "h").alias("h")).agg(_joined("h").alias("content_sha256"))


def changed(sealed: DataFrame, actual: DataFrame, by: list[str]) -> DataFrame:
    """(by..., leaf, problem): leaves that differ from the sealed ones, that are gone, or that were never sealed."""
    keys = [*by, "leaf"]
    x = sealed.select(*keys, F.col("leaf_sha256").alias("was")).join(actual.select(*keys, F.col("leaf_sha256").alias("now")), keys, "full_outer")
    problem = F.when(F.col("now").isNull(), "missing").when(F.col("was").isNull(), "not sealed").when(F.col("was") != F.col("now"), "changed")
    return x.select(*keys, problem.alias("problem")).where("problem is not null")


def _print(columns: list[str]) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(F.to_json(F.struct(*sorted(columns))), 256))


def fingerprinted(df: DataFrame) -> DataFrame:
    """``df`` with ``fingerprint``: SHA-256 of each row as JSON, its columns in order of name."""
    return df.withColumn("fingerprint", _print([c for c in df.columns if c != "fingerprint"]))


def genuine(df: DataFrame) -> DataFrame:
    """``df`` with ``genuine``: the row's fingerprint is that of its other columns."""
    own = _print([c for c in df.columns if c not in ("fingerprint", "genuine")])
    return df.withColumn("genuine", F.coalesce(F.col("fingerprint") == own, F.lit(False)))


def signal_problems(manifest: DataFrame, sealed: DataFrame, actual: DataFrame, session: str, freeze_minutes: int = 15) -> DataFrame:
    """(sym, problem): why the bars of a symbol may not back a session's signal; the first reason only, null where they may.

    ``manifest`` is one row of :func:`tessera.operators.ingest.manifest`, ``sealed`` its report, ``actual`` (sym, content_sha256) what
    the store holds now. Asked in turn: the fingerprint is the row's own; all expected symbols are there; there is a watermark; it is
    the session's midnight; the manifest was made within ``freeze_minutes`` of it; the symbol was sealed; its content is the sealed one."""
    opens = F.lit(session).cast("timestamp")
    late = ~((F.col("generated_at") >= opens) & (F.col("generated_at") < opens + F.make_interval(mins=F.lit(freeze_minutes))))
    of_all = (
        F.when(~F.col("genuine"), "fingerprint").when(~F.col("universe_complete"), "universe incomplete").when(F.col("watermark").isNull(), "no watermark")
        .when(F.col("watermark") != opens, "another session's watermark").when(F.coalesce(late, F.lit(True)), "made outside the window")
    )
    head = genuine(manifest).select(of_all.alias("whole"))
    x = sealed.select("sym", "status", F.col("content_sha256").alias("was")).join(actual.select("sym", F.col("content_sha256").alias("now")), "sym", "left")
    x = x.join(F.broadcast(head), F.lit(True))  # one row
    own = F.when(F.col("status") != "ok", "not sealed").when(F.coalesce(F.col("was") != F.col("now"), F.lit(True)), "content differs from the sealed one")
    return x.select("sym", F.coalesce("whole", own).alias("problem"))


def file_hashes(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """(partition, file, bytes, sha256) of a table's files, hashed in tasks; names are relative to the table."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    name = F.regexp_extract("path", r"((?:[^/=]+=[^/]*/)*[^/]+)$", 1)
    return files.select(F.regexp_extract(name, "^(.*)/[^/]*$", 1).alias("partition"), name.alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def bundle_problems(stated: DataFrame, found: DataFrame, needed: DataFrame, floor: float) -> DataFrame:
    """(name, problem): what is wrong with a published bundle. stated (name, template, sha256, child_sha256, status, coverage, columns) is
    its contract, found (name, sha256) its files as they are, needed (name, template, columns) what is asked for now."""
    x = needed.select("name", F.col("template").alias("want"), F.col("columns").alias("need"), F.lit(True).alias("_asked")).join(stated, "name", "full_outer").join(found.select("name", F.col("sha256").alias("actual")), "name", "left")
    lacks = F.size(F.array_except("need", F.coalesce("columns", F.array().cast("array<string>")))) > 0
    tests = [
        (F.col("template").isNull() & F.col("_asked"), "the bundle lacks it"),
        (F.col("_asked").isNull(), "nobody asked for it"),
        (F.col("want") != F.col("template"), "it was fetched from elsewhere"),
        (F.col("actual").isNull(), "its file is missing"),
        ((F.col("actual") != F.col("sha256")) | (F.col("actual") != F.col("child_sha256")), "its file is not the one that was recorded"),
        (F.coalesce(F.col("status") != "ok", F.lit(True)), "its status is not ok"),
        (F.coalesce(F.col("coverage") < floor, F.lit(True)), "its coverage is below the floor"),
        (F.coalesce(lacks, F.lit(True)), "it lacks a required column"),
    ]
    whole = F.col("_asked").isNotNull() & F.col("template").isNotNull()
    found_ = [F.when((test if k < 2 else whole & test), F.lit(text)) for k, (test, text) in enumerate(tests)]
    return x.select("name", F.explode(F.array_compact(F.array(*found_))).alias("problem"))
