"""Ranked lexical search by Fagin's threshold algorithm over shards of documents.

Documents are counted once and written as shards: of each document the terms that items ask for, with their counts. A shard
is its own index. Each of its terms has a list of documents by falling impact (the term's part of a score but for its
weight), and a forward index gives any document's impacts. For an item the lists of its terms are read in turn, a few
entries of each in every round; each document met for the first time is looked up in the forward index and so scored whole.
What the last entries read would score together is the threshold: no document that has not been met can score more. The
search of a shard ends when the threshold is strictly below the score of the k-th best document, of the shard or of those
that the task has searched before, so documents of equal scores are all met and ties are broken by id. The shards' best are
then ranked together.

Shards and blocks of items meet by an equi-join on salted keys, each pair once, so neither one block nor a frequent term
gathers rows in one task, and a task holds one shard and one block.

Terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z are lower-cased. Null and empty
texts have no terms, and such items no result. Equal rows are documents, or items, of their own; a null doc_id comes before all
others, a null item_id stays null. Empty tables give an empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, documents, offsets, ragged, texts

#: A shard ends after so many documents or counts of terms; a block has about so many items.
DOCS, COUNTS, ITEMS = 8192, 1_000_000, 256
#: Numbers in the forward index of the documents that are searched together: 64 MB.
CELLS = 1 << 24
#: Entries of each list that the first round reads; each later round reads twice as many, up to the last.
FIRST, LAST = 32, 4096
#: Bits of the map of asked terms: it is sent to every task, and its size is a constant.
MAP_BITS = 22
#: Items whose k-th scores a task remembers.
REMEMBERED = 200_000
NO_ID = -(1 << 63)

#: Bytes of terms stay, A-Z as lower case, all others become blanks.
_TERMS = bytes(b if b > 127 or chr(b).isalnum() and not chr(b).isupper() else b + 32 if 65 <= b <= 90 else 32 for b in range(256))

_SHARD = "shard long, n_docs long, n_terms long, ids binary, n binary, terms array<string>, df array<int>, doc binary, term binary, tf binary"
_FOUND = "item long, doc_id long, score long"


def terms(text: bytes) -> Counter:
    return Counter(text.translate(_TERMS).split())


def asked(items: DataFrame, scratch: Scratch, item_id: str, text: str) -> DataFrame:
    """(item, item_id, term, times): the terms of each item; ``item`` numbers its rows."""
    kind = items.schema[item_id].dataType

    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 33
        for batch in batches:
            own, got = batch.column("item_id"), [terms(t) for t in texts(batch)]
            rows = np.repeat(np.arange(len(got)), [len(c) for c in got])
            columns = [pa.array(at + rows), own.take(pa.array(rows)), pa.array([t.decode() for c in got for t in c], pa.string()), pa.array([x for c in got for x in c.values()], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["item", "item_id", "term", "times"])
            at += len(got)

    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text"))
    return scratch.save(rows.mapInArrow(part, f"item long, item_id {kind.simpleString()}, term string, times long"), "asked")


def term_map(terms_: DataFrame) -> np.ndarray:
    """A bit for each slot that a term of the column falls into; 2**MAP_BITS bits whatever the input."""
    slot = F.pmod(F.crc32(F.col(terms_.columns[0]).cast("binary")), F.lit(1 << MAP_BITS)) + 1
    number, place = (F.call_function(f, F.col("x")) for f in ("bitmap_bucket_number", "bitmap_bit_position"))
    maps = terms_.select(slot.alias("x")).groupBy(number.alias("block")).agg(F.bitmap_construct_agg(place).alias("map"))
    out = np.zeros(1 << (MAP_BITS - 3), np.uint8)
    for block, bits in maps.collect():
        out[(block - 1) << 12 : block << 12] = np.frombuffer(bits, np.uint8)
    return out


def sharded(docs: DataFrame, wanted: np.ndarray, doc_id: str, text: str) -> DataFrame:
    """Shards of the documents with the counts of terms that may be wanted, as the map says."""

    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bool] = {}
        shard = TaskContext.get().partitionId() << 32
        number, ids, n, size, doc, term, tf = {}, [], [], [], [], [], []
        seen, total = 0, 0

        def packed() -> pa.RecordBatch:
            nonlocal shard, number, ids, n, size, doc, term, tf, seen, total
            at = np.array(term, np.int32)
            df = np.bincount(at, minlength=len(number)).astype(np.int32)
            doc = np.repeat(np.arange(len(ids), dtype=np.int32), size)
            blobs = [np.array(ids, np.int64), np.array(n, np.int64), doc, at, np.array(tf, np.int32)]
            values = [shard, seen, total, *(x.tobytes() for x in blobs[:2]), [w.decode() for w in number], df.tolist(), *(x.tobytes() for x in blobs[2:])]
            kinds = [*[pa.int64()] * 3, pa.binary(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int32()), *[pa.binary()] * 3]
            shard += 1
            number, ids, n, size, doc, term, tf, seen, total = {}, [], [], [], [], [], [], 0, 0
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(values, kinds, strict=True)], "shard n_docs n_terms ids n terms df doc term tf".split())

        for batch in batches:
            for d, raw in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                counts = terms(raw)
                if not counts:
                    continue
                length, before = counts.total(), len(term)
                seen, total = seen + 1, total + length
                for w, k in counts.items():
                    hit = known.get(w)
                    if hit is None:
                        if len(known) > 500_000:
                            known.clear()
                        x = zlib.crc32(w) & ((1 << MAP_BITS) - 1)
                        hit = known[w] = bool(wanted[x >> 3] >> (x & 7) & 1)
                    if hit:
                        term.append(number.setdefault(w, len(number)))
                        tf.append(k)
                if len(term) > before:
                    ids.append(NO_ID if d is None else d)
                    n.append(length)
                    size.append(len(term) - before)
                if len(ids) >= DOCS or len(term) >= COUNTS:
                    yield packed()
        if seen:
            yield packed()

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(part, _SHARD)


class Lists:
    """Impact-sorted lists and the forward index of some documents of a shard, for the terms of one block of items."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        self.ids = ids
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.start = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.forward = np.zeros((len(ids), n_terms), np.int32)
        self.forward[doc, term] = impact

    def best(self, own: np.ndarray, weight: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the k best for the terms ``own``, none of those that score less than ``floor``, which k
        documents elsewhere reach."""
        start, size = self.start[own], self.start[own + 1] - self.start[own]
        kind = np.float64 if float(weight.sum()) * 1e6 < 2.0**52 else np.int64  # sums of doubles are exact
        seen, docs, scores = np.zeros(len(self.ids), bool), np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, step = 0, FIRST
        while depth < size.max(initial=0):
            met = np.zeros(len(self.ids), bool)
            met[self.doc[ragged(start + depth, np.clip(size - depth, 0, step))]] = True  # the next entries of every list
            new = np.flatnonzero(met & ~seen)
            seen |= met
            got = (self.forward[np.ix_(new, own)].astype(kind) @ weight.astype(kind)).astype(np.int64)
            fits = got >= max(floor, 1)
            docs, scores = np.concatenate([docs, new[fits]]), np.concatenate([scores, got[fits]])
            if len(docs) > k:
                top = np.lexsort((self.ids[docs], -scores))[:k]
                docs, scores = docs[top], scores[top]
            if len(docs) == k:
                floor = max(floor, int(scores.min()))
            depth, step = depth + step, min(2 * step, LAST)
            open_ = size >= depth
            threshold = int((weight[open_] * self.impact[start[open_] + depth - 1].astype(np.int64)).sum())
            if threshold < floor:
                break
        return docs, scores


def _searched(k: int, n_docs: int, n_terms: int):
    """Pairs of a shard and a block of items -> the shard's best documents of each item."""

    def lists(row: dict, number: dict[str, int]) -> Iterator[Lists]:
        ids, n = (np.frombuffer(row[c], np.int64) for c in ("ids", "n"))
        doc, term, tf = (np.frombuffer(row[c], np.int32) for c in ("doc", "term", "tf"))
        m = np.array([75 + 25 * int(x) * n_docs // n_terms for x in n], np.int64)
        to = np.array([number.get(t, -1) for t in row["terms"]], np.int64)
        keep = to[term] >= 0 if len(to) else np.zeros(0, bool)
        doc, term, tf = doc[keep].astype(np.int64), to[term[keep]], tf[keep].astype(np.int64)
        impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[doc])
        per = max(1, CELLS // max(1, len(number)))
        for a in range(0, len(ids), per):
            i, j = np.searchsorted(doc, (a, a + per))
            yield Lists(ids[a : a + per], doc[i:j] - a, term[i:j], impact[i:j], len(number))

    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached: dict[int, np.ndarray] = {}  # the k best scores of items so far
        for batch in batches:
            for row in batch.to_pylist():
                number: dict[str, int] = {}
                items = [(x["item"], np.array([number.setdefault(t["term"], len(number)) for t in x["terms"]], np.int64), np.array([t["weight"] for t in x["terms"]], np.int64)) for x in row["items"]]
                for at in lists(row, number):
                    for item, own, weight in items:
                        so_far = reached.get(item, np.zeros(0, np.int64))
                        docs, scores = at.best(own, weight, k, int(so_far[-1]) if len(so_far) == k else 0)
                        if len(docs):
                            if len(reached) > REMEMBERED:
                                reached.clear()
                            reached[item] = -np.sort(-np.concatenate([so_far, scores]))[:k]
                            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(docs), item)), pa.array(at.ids[docs]), pa.array(scores)], ["item", "doc_id", "score"])

    return part


def ranked(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents that score highest above 0 for each item, ties by ascending doc_id."""
    scratch = Scratch(docs.sparkSession, "ranking")
    wanted = asked(items, scratch, item_id, text)
    shards = scratch.save(sharded(docs, term_map(wanted.select("term")), doc_id, text), "shards")
    n_shards, n_docs, n_terms = shards.agg(F.count("*"), F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    df = shards.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.df").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    weighted = wanted.join(df, "term").select("item", "item_id", F.struct("term", (F.col("times") * weight).alias("weight")).alias("t")).where("t.weight > 0")
    packed = weighted.groupBy("item").agg(F.any_value("item_id").alias("item_id"), F.collect_list("t").alias("terms"))
    packed = scratch.save(packed, "items")
    n_blocks = -(-packed.count() // ITEMS)
    blocks = packed.groupBy(F.pmod(F.xxhash64("item"), F.lit(max(1, n_blocks))).alias("block")).agg(F.collect_list(F.struct("item", "terms")).alias("items"))
    # every pair of a shard and a block has a key of its own
    blocks = blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(max(1, n_shards) - 1))).alias("salt"))
    each = shards.select("shard", "ids", "n", "terms", "doc", "term", "tf", F.pmod(F.xxhash64("shard"), F.lit(max(1, n_shards))).cast("int").alias("salt"))
    pairs = each.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(1, n_blocks) - 1).cast("long")))).join(blocks.hint("merge"), ["block", "salt"])  # their copies grow with the shards, so they are never broadcast
    found = scratch.save(pairs.drop("block", "salt", "shard").mapInArrow(_searched(k, n_docs, n_terms), _FOUND), "found")
    found = found.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id")))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.join(packed.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op12_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 documents that score highest for each benchmark item."""
    return ranked(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_words = "unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t"
#: Every document that shares a term with an item is scored.
SQL = f"""WITH tf AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, {_words} FROM documents) GROUP BY ALL),
len AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id), st AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM len),
m AS (SELECT doc_id, 100 - 25 + (25 * n * n_docs) // n_terms AS m FROM len, st),
w AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, st GROUP BY t),
q AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, {_words} FROM benchmark) GROUP BY ALL),
s AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score FROM q JOIN w USING (t) JOIN tf USING (t) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0 QUALIFY rank <= 20"""
