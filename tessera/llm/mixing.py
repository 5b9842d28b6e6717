"""Operator 4: mixing sources to target weights by entropy balancing, in DataFrame functions only.

Each source s gets a target number of words T_s. Of all document rates between 0 and ``most`` that meet the targets,
entropy balancing takes those nearest to one copy each; they have the form min(most, exp(lambda_s * x)), x being the
document's words over its source's mean. lambda_s is the dual variable; Newton steps within a bracket solve the dual on
the table of (source, size, documents), each step one grouped sum. Rates become copies by rounding down, and a
threshold on hashed priorities (found by descending through bins, never by sorting a source) rounds up as many
documents as bring the source nearest to its target. Sums use exact decimals, so reruns agree.

Targets: sources in code point order, null last, weigh 5, 2, 1 in turn and share all words; a target stops at ``most``
times its source's words and the excess is shared by weight among the others, until none is above.

Cases: null or empty text has size 0 and is never taken; a null source is a source of its own, the last; rows that share
a doc_id are separate documents; equal rows share their priority and round alike; an empty table gives no rows; further
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, Scratch, documents, unused

WEIGHTS = (5, 2, 1)
#: Bits of a priority, and those that one descent decides.
BITS, STEP = 30, 10


def _sum(x: Column) -> Column:
    return F.sum(x.cast("decimal(38,6)")).cast("double")


def sources(sized: DataFrame, scratch: Scratch, weights: tuple[int, ...], most: int) -> DataFrame:
    """One row for each source: sid (its place in order), source, source_size, docs, weight, target."""
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.when(F.col("size") > 0, 1).otherwise(0)).alias("docs"))
    order = F.col("source").asc_nulls_last()
    ranged = scratch.save(by.repartitionByRange(order).sortWithinPartitions(order).withColumn("at", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("at", 33)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    first = ranged.groupBy(part.alias("part")).count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    place = ranged.join(first, part == first["part"]).withColumn("sid", F.col("first") + F.col("at").bitwiseAND((1 << 33) - 1))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") % len(weights) + 1).cast("int"))
    table = scratch.save(place.select("sid", "source", "source_size", "docs", weight.cast("double").alias("weight"), (F.col("source_size") * most).cast("double").alias("cap")), "weights")
    total, heavy = table.agg(F.sum("source_size"), F.sum("weight")).first()
    level, full = (total or 0) / (heavy or 1), -1
    while True:  # each round at least one more source stops at its cap, or the level stands
        above = F.col("cap") <= F.col("weight") * level
        n, held, rest = table.agg(F.count(F.when(above, 1)), F.sum(F.when(above, F.col("cap"))), F.sum(F.when(~above, F.col("weight")))).first()
        if n == full or not rest:
            break
        full, level = n, (total - (held or 0)) / rest
    return table.withColumn("target", F.least("cap", F.col("weight") * level))


def _rate(most: int) -> Column:
    tilted = F.exp(F.col("lam") * F.col("size") / F.col("mean"))
    return F.when(F.col("target") >= F.col("cap"), F.lit(float(most))).otherwise(F.least(F.lit(float(most)), tilted))


def balance(sized: DataFrame, table: DataFrame, scratch: Scratch, most: int, tolerance: float = 1e-9, rounds: int = 60) -> DataFrame:
    """Adds lam, each source's dual variable."""
    counts = scratch.save(sized.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n")), "counts")
    mean = F.greatest(F.lit(1.0), F.try_divide(F.col("source_size").cast("double"), F.col("docs")))
    state = scratch.save(table.withColumn("mean", mean).select("*", F.lit(0.0).alias("lam"), (F.col("mean") * -50).alias("lo"), (F.col("mean") * F.log(F.lit(most + 1e-6))).alias("hi"), F.lit(1.0).alias("err")), "dual")
    for _ in range(rounds):
        x = counts.withColumnRenamed("source", "s").join(state, F.col("s").eqNullSafe(F.col("source")))
        words = F.col("n") * F.col("size") * F.col("rate")
        slope = F.when(F.col("rate") < most, words * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = x.withColumn("rate", _rate(most)).groupBy("sid").agg(_sum(words).alias("got"), _sum(slope).alias("slope"))
        gap = F.col("target") - F.col("got")
        y = state.join(sums.withColumnRenamed("sid", "k"), F.col("sid") == F.col("k"), "left")
        y = y.withColumn("err", F.coalesce(F.when(F.col("target") >= F.col("cap"), 0.0).otherwise(F.abs(gap) / F.greatest(F.col("target"), F.lit(1.0))), F.lit(0.0)))
        y = y.withColumn("lo", F.when(gap > 0, F.col("lam")).otherwise(F.col("lo"))).withColumn("hi", F.when(gap < 0, F.col("lam")).otherwise(F.col("hi")))
        newton = F.col("lam") + F.try_divide(gap, F.col("slope"))
        step = F.when((newton > F.col("lo")) & (newton < F.col("hi")), newton).otherwise((F.col("lo") + F.col("hi")) / 2)
        after = scratch.save(y.withColumn("lam", F.when(F.col("err") > tolerance, step).otherwise(F.col("lam"))).select(*state.columns), "dual")
        scratch.drop(state)
        state = after
        if (state.agg(F.max("err")).first()[0] or 0) <= tolerance:
            break
    return state


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """docs (doc_id, text, source) -> the same rows as doc_id, source, text_hash, size, source_size, target, rate, copies."""
    scratch = Scratch(docs.sparkSession, "mixing")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = scratch.save(docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), size.alias("size")), "sized")
    state = balance(sized, sources(sized, scratch, weights, most), scratch, most)
    # u in (0, 1) by hash; a document rounds up where u / fraction is small enough
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", "text_hash"), 11) + 0.5) / float(1 << 53)
    s = state.select(F.col("source").alias("s"), "sid", "source_size", "target", "cap", "mean", "lam")
    rated = sized.join(s, F.col("source").eqNullSafe(F.col("s"))).withColumn("rate", _rate(most)).withColumn("base", F.floor("rate"))
    part = F.col("rate") - F.col("base")
    key = F.floor(F.least(F.try_divide(u, part), F.lit(3.999)) * float(1 << (BITS - 2)))
    rated = rated.withColumn("key", F.when((part > 0) & (F.col("size") > 0), key))
    keyed = rated.where("key is not null").select("sid", "key", "size")
    need = rated.groupBy("sid").agg(F.max("target").alias("target"), F.sum(F.col("base") * F.col("size")).alias("sure"))
    cut = scratch.save(need.select("sid", (F.col("target") - F.col("sure")).alias("need"), F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("weight")), "cut")
    for shift in range(BITS - STEP, -1, -STEP):
        c = cut.select(F.col("sid").alias("k"), "need", "prefix")
        bins = keyed.join(c, (F.col("sid") == F.col("k")) & (F.shiftright("key", shift + STEP) == F.col("prefix")))
        bins = bins.groupBy("sid", "need", F.shiftright("key", shift).alias("bin")).agg(F.sum("size").alias("w"))
        upto = Window.partitionBy("sid").orderBy("bin")  # 2**STEP bins at most
        bins = bins.withColumn("cum", F.sum("w").over(upto))
        over = F.col("cum") > F.col("need")
        found = bins.groupBy(F.col("sid").alias("k")).agg(F.max(F.when(~over, F.col("cum"))).alias("used"), F.min(F.when(over, F.struct("bin", "w"))).alias("at"))
        # without an overflowing bin every key below the next prefix rounds up
        after = cut.join(found, F.col("sid") == F.col("k"), "left").select(
            "sid", (F.col("need") - F.coalesce("used", F.lit(0))).alias("need"), F.coalesce("at.bin", F.shiftleft(F.col("prefix") + 1, STEP)).alias("prefix"), F.coalesce("at.w", F.lit(0)).alias("weight")
        )
        cut = scratch.save(after, "cut")
    last = F.when(F.col("need") * 2 > F.col("weight"), F.col("prefix")).otherwise(F.col("prefix") - 1)
    cut = cut.select(F.col("sid").alias("k"), last.alias("last"))
    up = F.coalesce((F.col("key") <= F.col("last")).cast("long"), F.lit(0))
    out = rated.join(cut, F.col("sid") == F.col("k"))
    return out.select("doc_id", "source", "text_hash", "size", "source_size", "target", "rate", (F.col("base") + up).alias("copies"))


def op4_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def apply(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """The rows of docs, each as many times as the mix takes it. Equal rows have equal copies, so a decision is found by
    the columns it depends on."""
    i, s, x, n, h, k = unused(docs.columns, "id", "source", "hash", "copies", "h", "k")
    d = mix(docs, weights, most).where("copies > 0").select(F.col("doc_id").alias(i), F.col("source").alias(s), F.col("text_hash").alias(x), F.col("copies").cast("int").alias(n)).distinct()
    keyed = docs.withColumn(h, F.xxhash64("text"))
    same = keyed["doc_id"].eqNullSafe(F.col(i)) & keyed["source"].eqNullSafe(F.col(s)) & (keyed[h] == F.col(x))
    return keyed.join(d, same).withColumn(k, F.explode(F.sequence(F.lit(1), n))).select(*(F.col(c) for c in docs.columns))
