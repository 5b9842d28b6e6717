"""Helpers that the corpus operators share: scratch tables, Arrow batches, hashed count tables, components."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as in the word pattern [^\x20\x09-\x0D]+ ; bytes.split() splits at exactly these.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Where a local session names none (tests), it is one of this machine."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        where = "/tmp/tessera-shared"
    return where.rstrip("/")


#: While a scratch table is written: shuffle files go with the write that made them, and an Arrow batch holds 16 MB at most.
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


@contextmanager
def writing(spark: SparkSession, at_once: int = 0):
    conf = _WRITING | {"spark.sql.maxConcurrentOutputFileWriters": str(at_once)}
    was = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class Scratch:
    """Tables written to the shared folder: they cut lineage and survive lost executors.

    ``save`` writes a frame once and returns the written table; ``drop`` deletes one that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.paths = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", {}

    def path(self, name: str) -> str:
        return f"{self.root}/{len(self.paths)}-{name}"

    def save(self, df: DataFrame, name: str = "t", by: str | None = None, at_once: int = 0, codec: str | None = None) -> DataFrame:
        """``by``: a column whose values get folders of their own, so a filter on it reads no others; up to ``at_once`` of them are
        written side by side, without a sort. ``codec``: another compression than the session's."""
        to = self.path(name)
        with writing(self.spark, at_once):
            df.write.parquet(to, partitionBy=by, compression=codec)
        out = self.spark.read.schema(df.schema).parquet(to)
        self.paths[id(out)] = (to, out)
        return out

    def drop(self, *frames: DataFrame, part: str = "") -> None:
        """``part``: of a table saved ``by`` a column, the folder of one value alone, as column=value."""
        for df in frames:
            to, _ = self.paths[id(df)]
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{to}/{part}" if part else to)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def give_back() -> None:
    """What this worker has freed goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # another system's library may lack it
        ctypes.CDLL(None).malloc_trim(0)


def tidied(run):
    """``run``, a function for mapInArrow, that gives what its task has freed back to the system at the end. Workers live on for
    other stages, and Arrow's pool and the allocator would keep it there."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def offsets(lengths: np.ndarray) -> np.ndarray:
    """Starts of consecutive runs, with the total as the last entry."""
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[i] .. starts[i] + lengths[i] - 1 for every i, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = offsets(lengths)[:-1]
    return np.arange(total, dtype=np.int64) + np.repeat(starts - first, lengths)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public splitmix64 constants), elementwise on uint64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BASE, PIECE = 0xD6E8FEB86659FD93, 1 << 20
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the hash's base and of its inverse, n of each or more."""
    if len(_POWERS[0]) < n:
        for i, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            x = np.full(max(n, PIECE + 1), b, np.uint64)
            x[0] = 1
            _POWERS[i] = np.cumprod(x)
    return _POWERS


def _pieces(data: bytes) -> Iterator[tuple[int, int]]:
    """Ranges of at most PIECE bytes that end at white space; a longer word stretches its own."""
    at, n = 0, len(data)
    while at < n:
        end = min(at + PIECE, n)
        if end < n:
            space = np.flatnonzero(_SPACES[np.frombuffer(data, np.uint8, end - at, at)])
            if len(space):
                end = at + int(space[-1]) + 1
            else:
                while end < n and not _SPACES[data[end]]:
                    end += 1
        yield at, end
        at = end


def words(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, line, hash) of every word of the lower-cased texts, in order; lines are numbered within their text. A word's
    64-bit hash is a polynomial over random letters, so all words of a block are hashed at once."""
    data = b"\n".join(raw).lower()
    begins = offsets(np.array([len(t) + 1 for t in raw], np.int64))[:-1]
    at, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    with np.errstate(over="ignore"):
        for a, b in _pieces(data):
            x = np.frombuffer(data, np.uint8, b - a, a)
            power, inverse = _powers(len(x) + 1)
            word = np.zeros(len(x) + 2, bool)
            np.logical_not(_SPACES[x], out=word[1:-1])
            edge = np.flatnonzero(word[1:] != word[:-1])
            start, end = edge[::2], edge[1::2]
            upto = np.zeros(len(x) + 1, np.uint64)
            np.cumsum(_LETTERS[x] * power[: len(x)], out=upto[1:])
            h = (upto[end] - upto[start]) * inverse[start]
            at.append(start + a)
            hashes.append(mixed(h + (end - start).astype(np.uint64) * np.uint64(_BASE)))
    at = np.concatenate(at)
    breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    text = np.searchsorted(begins, at, side="right") - 1
    line = np.searchsorted(breaks, at) - np.searchsorted(breaks, begins)[text]
    return text, line, np.concatenate(hashes)


def blocks(raw: list[bytes], size: int = 2 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """(first, texts): consecutive texts of about ``size`` bytes together."""
    first, held = 0, 0
    for i, t in enumerate(raw):
        held += len(t)
        if held >= size or i == len(raw) - 1:
            yield first, raw[first : i + 1]
            first, held = i + 1, 0


def slot_counts(df: DataFrame, bits: int, slots) -> np.ndarray:
    """A count table of fixed size, 2**bits numbers whatever the input: counts of hashed keys, exact up to 2048 and on a
    logarithmic scale beyond, so that it orders keys by rarity at any size.

    ``slots(batch)`` gives an array of slot numbers for a batch. Tasks send only their filled slots, block by block.
    Each count is an upper bound of the keys' true counts, so a slot below 2 proves that its keys are alone.
    Its size is a constant (2**bits two-byte numbers), so collecting and broadcasting it is bounded.
    """
    per = min(bits, 16)

    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, n = [], 0

        def packed():
            nonlocal got, n
            s, c = np.unique(np.concatenate(got), return_counts=True)
            got, n = [], 0
            cut = np.searchsorted(s, np.arange(1 + (1 << (bits - per)), dtype=np.int64) << per)
            rows = [(b, s[i:j], c[i:j]) for b, (i, j) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if j > i]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([b for b, _, _ in rows], pa.int32()),
                    pa.array([(s & ((1 << per) - 1)).astype(np.uint16).tobytes() for _, s, _ in rows], pa.binary()),
                    pa.array([c.astype(np.uint32).tobytes() for _, _, c in rows], pa.binary()),
                ],
                ["block", "slot", "n"],
            )

        for batch in batches:
            x = slots(batch)
            got.append(x)
            n += len(x)
            if n > 4_000_000:
                yield packed()
        if n:
            yield packed()

    def summed(key, pdf):
        import pandas as pd

        out = np.zeros(1 << per, np.int64)
        for s, c in zip(pdf["slot"], pdf["n"], strict=True):
            out[np.frombuffer(s, np.uint16)] += np.frombuffer(c, np.uint32)
        code = np.where(out < 2048, out, 2048 + 1024 * np.log2(np.maximum(out, 2048) / 2048))
        return pd.DataFrame({"block": [key[0]], "n": [code.astype(np.uint16).tobytes()]})

    rows = df.mapInArrow(tidied(part), "block int, slot binary, n binary").groupBy("block").applyInPandas(summed, "block int, n binary").collect()
    table = np.zeros(1 << bits, np.uint16)
    for r in rows:
        table[r["block"] << per : (r["block"] + 1) << per] = np.frombuffer(r["n"], np.uint16)
    return table


def maybe_among(df: DataFrame, key, keys: DataFrame, bits: int = 25, name: str = "_among") -> DataFrame:
    """``df`` with a column ``name``: false proves that ``key`` is not in ``keys`` (one column). A bitmap of fixed size,
    2**bits bits whatever the input, holds the keys' hashes, so its broadcast is bounded; with very many keys it fills and
    keeps every row, which costs a shuffle and changes no result. DataFrame functions only."""
    slot = lambda d: F.pmod(F.xxhash64(d), F.lit(1 << bits)) + 1
    number = lambda x: F.call_function("bitmap_bucket_number", x)
    x, block, map_ = unused([*df.columns, name], "x", "block", "map")
    maps = keys.select(slot(keys.columns[0]).alias(x)).groupBy(number(F.col(x)).alias(block)).agg(F.bitmap_construct_agg(F.call_function("bitmap_bit_position", F.col(x))).alias(map_))
    joined = df.withColumn(x, slot(key)).join(F.broadcast(maps), number(F.col(x)) == F.col(block), "left")
    byte = F.conv(F.hex(F.expr(f"substring({map_}, cast(bitmap_bit_position({x}) div 8 as int) + 1, 1)")), 16, 10).cast("int")
    bit = byte.bitwiseAND(F.expr(f"shiftleft(1, cast(bitmap_bit_position({x}) % 8 as int))")) != 0
    return joined.withColumn(name, F.coalesce(bit, F.lit(False))).drop(x, block, map_)


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of (a, b) links: (node, root), root the smallest node that is reached.

    Every round moves each node to its smallest neighbour, follows these moves to their end by pointer jumping (doubling)
    and contracts the links: only nodes below all their neighbours are left, so rounds and jumps grow with the logarithm
    of a component's size, whatever the order of its nodes. Only grouped minima and equi-joins are used, so a node with very many links needs no task that sees
    all of them.
    """
    nodes = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    live, moves = scratch.save(edges.where("a != b").select("a", "b").distinct(), "edges"), []
    while not live.isEmpty():
        both = live.union(live.select("b", "a"))
        parent = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("x"), F.least("a", "m").alias("p"))
        parent = scratch.save(_jumped(parent), "parent")
        while not parent.where("far").isEmpty():
            further = scratch.save(_jumped(parent.select("x", "p")), "parent")
            scratch.drop(parent)
            parent = further
        moves.append(parent)
        pa_, pb = parent.select(F.col("x").alias("xa"), F.col("p").alias("na")), parent.select(F.col("x").alias("xb"), F.col("p").alias("nb"))
        joined = live.join(pa_, live["a"] == F.col("xa")).join(pb, live["b"] == F.col("xb"))
        after = scratch.save(joined.select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).where("a != b").distinct(), "edges")
        scratch.drop(live)
        live = after
    labels = nodes.withColumn("root", F.col("node"))
    for parent in moves:
        labels = labels.join(parent.select("x", "p"), F.col("root") == F.col("x"), "left").select("node", F.coalesce("p", "root").alias("root"))
    labels = scratch.save(labels, "labels")
    scratch.drop(live, *moves)
    return labels


def _jumped(parent: DataFrame) -> DataFrame:
    """(x, p, far): each node's ancestor four steps up; far: there may be more. Every parent is itself an x of the table."""
    for _ in range(2):
        above = parent.select(F.col("x").alias("y"), F.col("p").alias("pp"))
        parent = parent.join(above, F.col("p") == F.col("y")).select("x", F.col("pp").alias("p"), (F.col("p") != F.col("pp")).alias("far"))
    return parent


def stored(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs`` as a table whose files know their rows: a plain scan of Parquet stays as it is, anything else (a scan of another
    format as well, which numbers no rows) is written first."""
    plan = docs._jdf.queryExecution().analyzed()
    scan = plan.getClass().getSimpleName() == "LogicalRelation" and plan.relation().getClass().getSimpleName() == "HadoopFsRelation" and plan.relation().fileFormat().toString() == "Parquet"
    return docs if scan and "_metadata" not in docs.columns else scratch.save(docs, "stored")


def row_key(docs: DataFrame) -> list[Column]:
    """Two numbers that name a row of a stored Parquet table in every later reading: its file's hash and its place there."""
    at = docs.metadataColumn("_metadata")
    return [F.xxhash64(at["file_path"]), at["row_index"]]


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, with underscores before them until they clash with no column."""
    taken, out = {c.lower() for c in columns}, []
    for x in names:
        while x.lower() in taken:
            x = f"_{x}"
        taken.add(x.lower())
        out.append(x)
    return out
