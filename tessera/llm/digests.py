"""Operator 7: canonical exact digests, in DataFrame functions only.

Canonical form: NFKC (the ICU library that Spark ships, called by the SQL function ``reflect``), full case folding, NFKC
again, runs of white space to one blank, trimmed. The digest is 128 bits of xxhash64 under two seeds. Documents with equal
digests are then compared byte by byte, and edited texts with all others by SHA-256: within a digest that holds different
canonical texts, all but the first of them (by SHA-256) get a number after the digest, so equal fingerprints mean equal
canonical texts.

Cases: a null text is empty; a null doc_id sorts first; rows that share a doc_id are ordered by text hash; one row alone
is its own next document; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, documents, maybe_among

_SPACE = r"[\s\x{85}\x{1680}\x{180e}\x{2028}\x{2029}]+"


def canonical(text: Column) -> Column:
    nfkc = lambda x: F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), x, F.lit(True))
    fold = F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), nfkc(text), F.lit(True))
    return F.trim(F.regexp_replace(nfkc(fold), _SPACE, " "))


def digest(canon: Column) -> Column:
    return F.lower(F.concat(*(F.lpad(F.hex(F.xxhash64(F.lit(seed), canon)), 16, "0") for seed in (1, 2))))


def _bucket(docs: DataFrame) -> tuple[Column, int]:
    """Ranges of doc_id that hold about the square root of all documents each: their bounds (as many) fit the plan."""
    n = docs.count()
    many = max(1, math.isqrt(n))
    wanted = [i / many for i in range(1, many)]
    bounds = docs.agg(F.percentile_approx("doc_id", wanted, 10 * many)).first()[0] if wanted else []
    bounds = sorted(set(bounds or []))
    step = math.isqrt(len(bounds)) + 1
    fine = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    below = lambda a: F.size(F.filter(a, lambda b: b <= F.col("doc_id")))
    coarse = below(F.from_json(F.lit(json.dumps([x[0] for x in fine])), "array<bigint>"))
    rows = F.from_json(F.lit(json.dumps([[], *fine])), "array<array<bigint>>")
    return F.greatest(F.lit(0), (coarse - 1) * step) + below(F.element_at(rows, coarse + 1)), len(bounds) + 1


def with_next(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, text, next_text: the text of the next document by doc_id, after the last that of the first. One shuffle."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    bucket, _ = _bucket(docs)
    keyed = docs.select(bucket.alias("bucket"), "doc_id", F.xxhash64("text").alias("h"), "text", F.lit(0).alias("guest"))
    ids = docs.select(bucket.alias("bucket"), "doc_id").groupBy("bucket").agg(F.min("doc_id").alias("m"), F.count(F.when(F.col("doc_id").isNull(), 1)).alias("nulls"))
    lead = F.lead("bucket").over(Window.orderBy(F.col("bucket").desc()))  # a row for each bucket
    # the bucket before takes the first document of each as a guest at its end; the last bucket takes that of the first
    firsts = ids.select(F.col("bucket").alias("own"), F.when(F.col("nulls") == 0, F.col("m")).alias("m"), F.coalesce(lead, F.max("bucket").over(Window.partitionBy())).alias("bucket"))
    firsts = scratch.save(firsts, "firsts")
    guests = docs.join(firsts, F.col("doc_id").eqNullSafe(F.col("m")))
    guests = guests.groupBy("bucket", "own").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("x"))
    guests = guests.select("bucket", F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("h"), "x.text", F.lit(1).alias("guest"))
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_first(), "h")
    return keyed.unionByName(guests).withColumn("next_text", F.lead("text").over(order)).where("guest = 0").select("doc_id", "text", "next_text")


def _maybe_shared(canon: DataFrame, many: DataFrame) -> DataFrame:
    """Drops most texts whose digest nobody shares before they are shuffled; the join that follows drops the others."""
    return maybe_among(canon, "digest", many).where("_among").select("canon", "digest")


def number_clashes(docs: DataFrame, digests: DataFrame, scratch: Scratch) -> DataFrame:
    """(digest, sha, number) of canonical texts, edited ones too, that share a digest with a different one: hardly ever a
    row. Texts of documents are compared byte by byte; edited texts, which are not stored, by their SHA-256."""
    many = scratch.save(digests.groupBy("digest").count().where("count > 1").select(F.col("digest").alias("d")), "many")
    canon = docs.select(canonical(F.coalesce("text", F.lit(""))).alias("canon")).withColumn("digest", digest(F.col("canon")))
    held = _maybe_shared(canon, many).join(many, F.col("digest") == F.col("d"), "left_semi")
    differ = held.groupBy("digest").agg(F.min("canon").alias("a"), F.max("canon").alias("b")).where("a <> b").select(F.col("digest").alias("d"))
    both = digests.select("digest", "sha").union(digests.select("edited_digest", "edited_sha"))
    differ = differ.union(both.groupBy("digest").agg(F.min("sha").alias("a"), F.max("sha").alias("b")).where("a <> b").select("digest"))
    differ = scratch.save(differ.distinct(), "differ")
    number = F.row_number().over(Window.partitionBy("digest").orderBy("sha")) - 1
    texts = both.join(differ, F.col("digest") == F.col("d"), "left_semi").distinct()
    return scratch.save(texts.withColumn("number", number).where("number > 0").select("digest", "sha", "number"), "clashes")


def fingerprints(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    half = F.floor(F.length("text") / 2).cast("int")
    rows = with_next(docs, scratch).withColumn("edited", F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 2) as int))"), F.expr("left(next_text, cast(floor(length(text) / 2) as int))")))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), half.alias("half"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), canonical(F.col("text")).alias("c"), canonical(F.col("edited")).alias("e"), canonical(F.col("next_text")).alias("n"))
    same = lambda a, b: (F.col(a).cast("binary") == F.col(b).cast("binary")).cast("double")
    sha = lambda x: F.sha2(F.col(x).cast("binary"), 256)
    rows = rows.select("doc_id", "n_chars", "edited_sha256", digest(F.col("c")).alias("digest"), sha("c").alias("sha"), digest(F.col("e")).alias("edited_digest"), sha("e").alias("edited_sha"), same("c", "e").alias("near_edited"), same("c", "n").alias("near_next"))
    rows = scratch.save(rows, "digests")
    clashes = number_clashes(docs, rows, scratch)
    for d, s, out in (("digest", "sha", "fingerprint"), ("edited_digest", "edited_sha", "edited_fingerprint")):
        c = clashes.select(F.col("digest").alias("cd"), F.col("sha").alias("cs"), "number")
        rows = rows.join(c, (F.col(d) == F.col("cd")) & (F.col(s) == F.col("cs")), "left")
        rows = rows.withColumn(out, F.concat(F.col(d), F.coalesce(F.concat(F.lit("-"), F.col("number")), F.lit("")))).drop("cd", "cs", "number")
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op7_canonical_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir), Scratch(spark, "op7"))
