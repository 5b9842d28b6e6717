"""Hard negatives by norm-bucketed search over vectors of integers.

All rows are sorted by norm, longest first, and cut into buckets; anchors are packed into blocks. A score cannot exceed the
product of two norms (Cauchy and Schwarz), so a window of scores needs no bucket whose longest vector, times the anchor's
norm, stays below the window's lower limit or below the worst score of a full list. Buckets are searched in waves, each four
times the one before: a wave pairs every block with every bucket of the wave that one of its windows still needs, and the
lists after it give the next wave's limits. The search ends when no window needs a further bucket; nothing else is
left out, so results are exact.

What defines a row's part: a null id, label or vector, or a component that is null or not finite, takes it out. A vector
that is shorter than another counts as zero where it has no component. Scaled components beyond 2**26 in size count as
2**26, so scores stay exact. Rows of one id, equal or not, are rows of their own; only rows of another id count as an
anchor's "other" rows, and ties of score and id are broken at will, as nothing else of a row is returned. An empty
table gives an empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch

#: Rows of a bucket and anchors of a block; vectors of 64 components make 1 MB and 256 kB.
BUCKET, BLOCK = 4096, 1024
#: Anchors whose scores with a bucket are held together.
HELD = 64
#: A wave has so many times the buckets of all waves before.
GROWTH = 4
#: The rounding of norms, as a share.
SLACK = 1 + 1e-9
LARGEST = float(1 << 26)

_PACKED = "part int, k int, n int, top double, ids binary, labels binary, norms binary, dim int, vectors binary"
_FOUND = "block long, i int, w int, score long, id long"


def prepared(df: DataFrame, id_: str, label: Column, vector: str, scale: int) -> DataFrame:
    """(id, label, v, norm) of the rows that take part; v: floor(scale * x) of each component."""
    df = df.select(F.col(id_).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("x"))
    whole = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    df = df.where("id is not null and label is not null and x is not null").where(whole)
    v = F.transform("x", lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(LARGEST)), F.lit(-LARGEST))).cast("int"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    return df.select("id", "label", v.alias("v")).withColumn("norm", norm)


def packed(rows: DataFrame, size: int) -> DataFrame:
    """Buckets of at most ``size`` rows, longest vectors first: bucket k of range partition ``part``. Equal norms are told
    apart by the id, so rows of one norm are spread over partitions as well."""
    rows = rows.repartitionByRange(F.desc("norm"), F.asc("id")).sortWithinPartitions(F.desc("norm"), F.asc("id"))

    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, k, own = [], 0, 0, TaskContext.get().partitionId()

        def bucket(t: pa.Table) -> pa.RecordBatch:
            ids, labels, norms = (t.column(c).to_numpy().astype(kind) for c, kind in (("id", np.int64), ("label", np.int64), ("norm", np.float64)))
            v = t.column("v").combine_chunks()
            lengths = v.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            dim = int(lengths.max(initial=0))
            vectors = np.zeros((t.num_rows, dim), np.int32)
            vectors[np.arange(dim) < lengths[:, None]] = v.flatten().to_numpy()
            values = [own, k, t.num_rows, float(norms.max(initial=0)), ids.tobytes(), labels.tobytes(), norms.tobytes(), dim, vectors.tobytes()]
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), *[pa.binary()] * 3, pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(values, kinds, strict=True)], "part k n top ids labels norms dim vectors".split())

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            while n >= size:
                t = pa.Table.from_batches(held)
                yield bucket(t.slice(0, size))
                rest, k, n = t.slice(size), k + 1, n - size
                held = rest.to_batches()
        if n:
            yield bucket(pa.Table.from_batches(held))

    return rows.mapInArrow(part, _PACKED)


def _unpacked(row: dict, prefix: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n, dim = row[prefix + "n"], row[prefix + "dim"]
    of = lambda name, kind: np.frombuffer(row[prefix + name], kind)
    return of("ids", np.int64), of("labels", np.int64), of("norms", np.float64), of("vectors", np.int32).reshape(n, dim)


def _scores(a: np.ndarray, b: np.ndarray, most: float) -> np.ndarray:
    """Inner products of the rows, exact: in doubles where ``most``, a bound of any partial sum, is below 2**53."""
    dim = min(a.shape[1], b.shape[1])
    kind = np.float64 if most < 2.0**52 else np.int64
    return (a[:, :dim].astype(kind) @ b[:, :dim].astype(kind).T).astype(np.int64)


def _scanned(same: bool, most: int):
    """For each pair of a block and a bucket: the best ``most`` rows of each window, of the anchor's label or of others."""

    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                qid, qlabel, qnorm, q = _unpacked(row, "q_")
                cid, clabel, _, c = _unpacked(row, "")
                i, w = (np.array([x[name] for x in row["windows"]], np.int64) for name in ("i", "w"))
                low, high = (np.array([x[name] for x in row["windows"]], np.int64) for name in ("need", "hi"))
                live = low <= qnorm[i] * row["top"] * SLACK
                i, w, low, high = i[live], w[live], low[live], high[live]
                for a in range(0, len(i), HELD):
                    own, at = np.unique(i[a : a + HELD], return_inverse=True)
                    s = _scores(q[own], c, float(qnorm[own].max() * row["top"]))
                    fits = (qlabel[own][:, None] == clabel) == same
                    if same:
                        fits &= qid[own][:, None] != cid
                    s, fits = s[at], fits[at]
                    fits &= (s >= low[a : a + HELD, None]) & (s <= high[a : a + HELD, None])
                    which, col = np.nonzero(fits)
                    score, ids = s[which, col], cid[col]
                    order = np.lexsort((ids, -score, which))
                    which, score, ids = which[order], score[order], ids[order]
                    first = np.searchsorted(which, which)
                    top = np.arange(len(which)) - first < most
                    which, score, ids = which[top], score[top], ids[top]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(which), row["block"])), pa.array(i[a + which].astype(np.int32)), pa.array(w[a + which].astype(np.int32)), pa.array(score), pa.array(ids)],
                        ["block", "i", "w", "score", "id"],
                    )

    return part


class Index:
    """Buckets of all rows, written once; ``search`` answers windows of blocks of anchors."""

    def __init__(self, rows: DataFrame, scratch: Scratch):
        self.scratch = scratch
        self.buckets = scratch.save(packed(rows, BUCKET), "buckets", by="part")
        # one row for each range partition, so bounded by a setting
        counts = sorted(tuple(r) for r in self.buckets.groupBy("part").agg(F.count("*"), F.sum("n")).collect())
        self.parts, self.first, at = [p for p, _, _ in counts], {}, 0
        for p, n, _ in counts:
            self.first[p], at = at, at + n
        self.total = at
        #: Buckets of the first wave: about BUCKET rows, as partitions of few rows make small buckets.
        self.start = max(1, BUCKET * at // max(1, sum(n for *_, n in counts)))

    def ranked(self, low: int, high: int) -> DataFrame:
        """Buckets low .. high - 1 by norm, with their ranks; files of other partitions are not read."""
        parts = [p for k, p in enumerate(self.parts) if self.first[p] < high and (k + 1 == len(self.parts) or self.first[self.parts[k + 1]] > low)]
        spark = self.buckets.sparkSession
        first = F.broadcast(spark.createDataFrame([(p, self.first[p]) for p in parts], "part int, first int"))
        near = self.buckets.where(F.col("part").between(parts[0], parts[-1])).join(first, "part")
        return near.withColumn("rank", F.col("first") + F.col("k")).where(F.col("rank").between(low, high - 1)).drop("part", "k", "first")

    def search(self, blocks: DataFrame, windows: DataFrame, same: bool, most: int) -> DataFrame:
        """The best ``most`` rows (block, i, w, score, id) for each of the windows (block, i, w, norm, lo, hi), by falling
        score, then id; ``same``: among other rows of the anchor's label, else among rows of other labels."""
        scratch, best, low = self.scratch, None, 0
        window = Window.partitionBy("block", "i", "w").orderBy(F.desc("score"), "id")
        q = blocks.select("block", *(F.col(c).alias("q_" + c) for c in ("n", "ids", "labels", "norms", "dim", "vectors")))
        while low < self.total:
            high = min(self.total, max(self.start, low * GROWTH))
            need = windows.select("block", "i", "w", "norm", "hi", F.col("lo").alias("need"))
            if best is not None:
                full = best.groupBy("block", "i", "w").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") == most).drop("n")
                need = need.join(full, ["block", "i", "w"], "left").withColumn("need", F.greatest("need", "kth")).drop("kth")
            wave = self.ranked(low, high)
            top = wave.agg(F.max("top")).first()[0]
            need = need.where(F.col("need") <= F.col("norm") * F.lit(top * SLACK))
            need = need.groupBy("block").agg(F.collect_list(F.struct("i", "w", "need", "hi")).alias("windows"), F.min(F.when(F.col("norm") > 0, F.col("need") / F.col("norm")).otherwise(F.lit(0.0))).alias("least"))
            need = scratch.save(need, "need")  # a row for each block: all of its windows are bounded by its anchors
            if need.isEmpty():
                break
            pairs = need.select("*", F.explode(F.sequence(F.lit(low), F.lit(high - 1))).alias("rank"))
            pairs = pairs.join(wave.select("rank", "top"), "rank").where(F.col("top") * SLACK >= F.col("least")).drop("top")
            found = pairs.join(q, "block").join(wave, "rank").mapInArrow(_scanned(same, most), _FOUND)
            found = found if best is None else best.unionByName(found)
            after = scratch.save(found.withColumn("r", F.row_number().over(window)).where(F.col("r") <= most).drop("r"), "best")
            scratch.drop(need, *([best] if best is not None else []))
            best, low = after, high
        return blocks.sparkSession.createDataFrame([], _FOUND) if best is None else best


def _down(x: Column) -> Column:
    """x / 100, rounded down."""
    return F.call_function("div", x - F.pmod(x, F.lit(100)), F.lit(100))


def mine(df: DataFrame, anchors: Column, id_: str = "vec_id", label: str | Column = "label", vector: str = "embedding", positives: int = 5, negatives: int = 5, lower: int = 80, upper: int = 100, scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every anchor, a condition on ``id``,
    and each of its best ``positives`` other rows of its label, the best ``negatives`` rows of other labels whose score is
    between ``lower`` and ``upper`` percent of the positive's. Higher scores come first, then smaller ids."""
    scratch = Scratch(df.sparkSession, "negatives")
    rows = prepared(df, id_, F.col(label) if isinstance(label, str) else label, vector, scale)
    index = Index(rows, scratch)
    blocks = packed(rows.where(anchors), BLOCK).withColumn("block", F.col("part").cast("long") * F.lit(1 << 32) + F.col("k"))
    blocks = scratch.save(blocks.drop("part", "k"), "blocks")

    def listed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, _, norms, _ = _unpacked(row, "")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), row["block"])), pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids), pa.array(norms)], ["block", "i", "anchor_id", "norm"])

    each = scratch.save(blocks.mapInArrow(listed, "block long, i int, anchor_id long, norm double"), "anchors")
    wide = [F.lit(0).alias("w"), F.lit(-(1 << 62)).alias("lo"), F.lit(1 << 62).alias("hi")]
    near = index.search(blocks, each.select("block", "i", "norm", *wide), True, positives)
    place = F.row_number().over(Window.partitionBy("block", "i").orderBy(F.desc("score"), "id"))
    near = near.select("block", "i", place.alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    least, largest = (F.col("positive_score") * x for x in (lower, upper))
    windows = each.join(near, ["block", "i"]).withColumn("lo", -_down(-least)).withColumn("hi", _down(largest))
    windows = scratch.save(windows.where("lo <= hi"), "windows")
    hard = index.search(blocks, windows.select("block", "i", "w", "norm", "lo", "hi"), False, negatives)
    rank = F.row_number().over(Window.partitionBy("block", "i", "w").orderBy(F.desc("score"), "id"))
    hard = hard.select("block", "i", "w", rank.alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return windows.join(hard, ["block", "i", "w"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose vec_id is divisible by 100; labels of ids divisible by 7 are shifted first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 100 == 0, label=label)


#: Every pair of an anchor and a row, scored by the lists' dot product.
SQL = """WITH e AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.id AS a, e.id, e.label = a.label AS same, CAST(list_dot_product(a.v, e.v) AS BIGINT) AS s FROM e a JOIN e ON a.id % 100 = 0
), p AS (
  SELECT a, id, s FROM s WHERE same AND a <> id QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, id) <= 5
)
SELECT p.a AS anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.a, p.id ORDER BY n.s DESC, n.id) AS INTEGER) AS rank, n.id AS negative_id, p.s AS positive_score, n.s AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 80 * p.s <= 100 * n.s AND 100 * n.s <= 100 * p.s
QUALIFY rank <= 5"""
