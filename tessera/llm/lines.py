"""Operator 8: line deduplication by an exact set-similarity join.

A line is the set of its lower-cased words; lines with equal sets (by a 128-bit digest) form a class, which its first line
stands for. Lines are ordered by doc_id (null last), then by their place in the text, then by row. A line goes if an
earlier one, kept or not, has Jaccard similarity of ``percent`` or more: later members of a class always do, a first one if
a class that comes first earlier is similar.

The join counts words over classes and orders each set by rarity (a hashed count table of fixed size; any fixed order is
exact). Each set is indexed under the words of its prefix, one of which any similar set shares; words that one class alone
has are left out. Pairs of a list must pass the length and positional filters and a bound on the sets' difference (bits of
parity: each word that one set lacks flips one bit at most); Jaccard on the words of the lines verifies.

No list is expanded into all its pairs:
- A line meets the FEW earlier ones of a list that may be most similar. Lines with more that found no match meet all others.
- In a list of more than HOT lines they meet LEAD leaders only, the first of the list, so copies with edits find their
  source. What finds none is looked for under two words: similar sets share two words of prefixes that are one longer.

Cases: lines without a word stay and match nothing; a null text stays null; repeated rows are separate (the later loses its
lines); a document whose lines all go keeps an empty text; an empty table gives no rows; extra columns pass through, whatever
their names. A frame that is not a stored Parquet table is stored first, so rows keep their keys.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, blocks, documents, maybe_among, mixed, offsets, ragged, row_key, slot_counts, stored, texts, tidied, unused, words

SLOT_BITS, ASKED_BITS, FEW, HOT, LEAD = 24, 25, 8, 1024, 64
_KEYED = "id long, f long, r long"
_INDEX = "key long, cid long, id long, line int, r long, n int, pos int, m long, o long"


def _sets(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, line, set size, hashes): the word sets of all lines with a word, one after another, hashes ascending."""
    text, line, h = words(raw)
    own = np.cumsum((np.diff(text, prepend=-1) != 0) | (np.diff(line, prepend=-1) != 0)) - 1
    order = np.argsort((own.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24)))
    own_, h_ = own[order], h[order]
    odd = (own_[1:] == own_[:-1]) & (h_[1:] < h_[:-1])  # the sort saw 40 bits of each hash
    if odd.any():
        order = np.lexsort((h, own))
        own_, h_ = own[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (own_[1:] != own_[:-1]) | (h_[1:] != h_[:-1])
    own_, h_ = own_[new], h_[new]
    first = np.flatnonzero(np.diff(own, prepend=-1))
    return text[first], line[first], np.bincount(own_, minlength=len(first)), h_


def _digests(size: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit digests of sets: sums of mixed hashes, and the size."""
    start = offsets(size)[:-1]
    out = []
    with np.errstate(over="ignore"):
        for salt in (0x51ED270B, 0xA3B1C6D5):
            sums = np.add.reduceat(mixed(h ^ np.uint64(salt)), start) if len(size) else np.zeros(0, np.uint64)
            out.append(mixed(sums + size.astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def _heads(keyed: DataFrame) -> DataFrame:
    """All lines with a word: place, and n, digest and word hashes (32 bits each) where no earlier line of the batch has the
    same set; the others have n 0 and a digest of their own, so no copies of a line meet before they are one for each
    batch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [[at + x if i == 0 else x for i, x in enumerate(_sets(raw))] for at, raw in blocks(texts(batch))]
            if not parts:
                continue
            row, line, size, h = (np.concatenate(x) for x in zip(*parts, strict=True))
            key = {c: batch.column(c).to_numpy()[row] for c in ("id", "f", "r")}
            d1, d2 = _digests(size, h)
            order = np.lexsort((key["f"], key["r"], line, key["id"], d2, d1))
            later = np.zeros(len(row), bool)
            later[order[1:]] = (d1[order[1:]] == d1[order[:-1]]) & (d2[order[1:]] == d2[order[:-1]])
            n = np.where(later, 0, size).astype(np.int32)
            packed = (h >> np.uint64(32)).astype(np.uint32)[np.repeat(~later, size)]
            held = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((offsets(n.astype(np.int64)) * 4).astype(np.int32).tobytes()), pa.py_buffer(packed.tobytes())])
            d2[later] = mixed(d2[later].view(np.uint64) ^ (key["r"][later] << 20 | line[later]).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in (*key.values(), line.astype(np.int32), n, d1, d2)), held], ["id", "f", "r", "line", "n", "d1", "d2", "h"])

    return keyed.mapInArrow(tidied(run), f"{_KEYED}, line int, n int, d1 long, d2 long, h binary")


def _classes(heads: DataFrame) -> DataFrame:
    """``heads`` with ``first``: whether a line stands for its class. Rows of a digest are neighbours in a sorted task."""
    place = ["id", "line", "r", "f"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            d1, d2, n = (batch.column(c).to_numpy() for c in ("d1", "d2", "n"))
            if not len(n):
                continue
            new = np.ones(len(n), bool)
            new[1:] = (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])
            new[0] = last != (d1[0], d2[0])
            last = (d1[-1], d2[-1])
            first = new & (n > 0)
            h = pc.if_else(pa.array(first), batch.column("h"), pa.scalar(None, pa.binary()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "f", "r", "line", "n")), h, pa.array(first)], ["id", "f", "r", "line", "n", "h", "first"])

    # of a digest, lines with a set come before those (by chance of the same digest) without
    ordered = heads.repartition("d1", "d2").sortWithinPartitions("d1", "d2", F.col("n") == 0, *place)
    return ordered.mapInArrow(tidied(run), f"{_KEYED}, line int, n int, h binary, first boolean").withColumn("cid", F.monotonically_increasing_id())


def prefix(n: np.ndarray, percent: int) -> np.ndarray:
    """Words of a set of n that any similar set shares one of."""
    return n - -(-percent * n // 100) + 1


def _ordered(batch: pa.RecordBatch, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, hash, count) of the words of a batch's sets, each set's by rarity."""
    size = batch.column("n").to_numpy()
    h = np.frombuffer(b"".join(batch.column("h").to_pylist()), np.uint32)
    own = np.repeat(np.arange(len(size), dtype=np.uint64), size)
    count = table[h >> (32 - SLOT_BITS)]
    order = np.sort((own << np.uint64(48)) | (count.astype(np.uint64) << np.uint64(32)) | h)  # batches have under 65,536 rows
    return (order >> np.uint64(48)).astype(np.int64), (order & np.uint64(0xFFFFFFFF)).astype(np.int64), (order >> np.uint64(32)).astype(np.int64) & 0xFFFF


def _parity(h: np.ndarray, start: np.ndarray) -> list[pa.Array]:
    """128 bits of each set, in two numbers: each word flips one."""
    bit = mixed(h.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    one = np.uint64(1) << (bit & np.uint64(63))
    high = (bit >> np.uint64(6)) & np.uint64(1)
    return [pa.array(np.bitwise_xor.reduceat(one * (high == k), start).view(np.int64)) for k in (0, 1)]


def _index(classes: DataFrame, percent: int, counts, asked=None) -> DataFrame:
    """A row for each indexed word of each class: key (the word), its place in the set's order, n and parity bits m. With
    ``asked``, a bitmap of _asked_bits, only those that it may hold."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 8192):
                batch = whole.slice(i, 8192)
                size = batch.column("n").to_numpy()
                start = offsets(size)[:-1]
                own, h, count = _ordered(batch, counts.value)
                # smaller sets can only be similar to equal ones, which are one class already
                at = ragged(start, np.where(size > percent // (100 - percent) - 1, prefix(size, percent), 0))
                at = at[count[at] > 1]
                if asked is not None:
                    at = at[_held(asked.value, _asked_slots(h[at], _class_of(size[own[at]], percent)))]
                if not len(at):
                    continue
                k = own[at]
                those, own_ = np.unique(k, return_inverse=True)  # the sets that have rows
                parity = _parity(h[ragged(start[those], size[those])], offsets(size[those])[:-1])
                take = lambda c: pa.array(batch.column(c).to_numpy()[k])
                yield pa.RecordBatch.from_arrays([pa.array(h[at]), take("cid"), take("id"), take("line"), take("r"), take("n"), pa.array((at - start[k]).astype(np.int32)), *(m.take(pa.array(own_)) for m in parity)], [x.split()[0] for x in _INDEX.split(", ")])

    return classes.select("cid", "id", "line", "r", "n", "h").mapInArrow(tidied(run), _INDEX)


def _overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """Words that similar sets of n words together (both sizes added) share at least."""
    return -(-percent * n // (100 + percent))


def _meet(c: dict[str, np.ndarray], start: np.ndarray, few: int, percent: int, since: int = 1, most: int = 1 << 62) -> tuple[np.ndarray, ...]:
    """(x, y, spare, cut short): rows x of a run with earlier rows y of it that pass the filters: for each x the ``few`` that
    may be most similar, or all, if ``c`` has ``asked``, for the x where it is set. spare: words by which they may differ
    more than their parity bits show; cut short: rows that had more to meet. Rows of a run are in the lines' order and
    ``start`` is the first of each one's. Only rows from ``since`` on look for others, and only among the first ``most``."""
    n, pos, m, o = c["n"].astype(np.int64), c["pos"].astype(np.int64), c["m"].view(np.uint64), c["o"].view(np.uint64)
    depth, got, asked = np.arange(len(n)) - start, np.zeros(len(n), np.int64), c.get("asked")
    look = np.flatnonzero((depth > 0) & (np.arange(len(n)) >= since) & (True if asked is None else asked))
    look = look[np.argsort(-depth[look], kind="stable")]  # so those that have a j-th row before them come first
    deep, first, size = -depth[look], start[look], n[look]
    found, held = [(np.zeros(0, np.int64),) * 3], 0

    def likeliest() -> list[tuple[np.ndarray, ...]]:
        x, y, spare = (np.concatenate(k) for k in zip(*found, strict=True))
        if asked is None and len(x):
            order = np.lexsort((y, -spare, x))
            x, y, spare = x[order], y[order], spare[order]
            begin = np.flatnonzero(np.diff(x, prepend=-1))
            keep = np.arange(len(x)) - np.repeat(begin, np.diff(np.append(begin, len(x)))) < few
            x, y, spare = x[keep], y[keep], spare[keep]
        return [(x, y, spare)]

    for j in range(min(most, -int(deep[0]) if len(deep) else 0)):
        y = first[: np.searchsorted(deep, -j)] + j
        at = np.flatnonzero((percent * size[: len(y)] <= 100 * n[y]) & (percent * n[y] <= 100 * size[: len(y)]))
        x, y = look[at], y[at]
        total = n[x] + n[y]
        need = _overlap(total, percent)
        spare = total - 2 * need - np.bitwise_count(m[x] ^ m[y]).astype(np.int64) - np.bitwise_count(o[x] ^ o[y])
        ok = (spare >= 0) & (np.minimum(pos[x], pos[y]) + np.minimum(n[x] - pos[x], n[y] - pos[y]) >= need) & (c["cid"][x] != c["cid"][y])
        x = x[ok]
        if len(x):
            found.append((x, y[ok], spare[ok]))
            got[x] += 1
            held += len(x)
            if held > 2_000_000 and asked is None:
                found, held = likeliest(), 0
    return *likeliest()[0], np.flatnonzero(got > few)


def _met(rows: DataFrame, percent: int, few: int, hot: int, lead: int, ask: bool = False) -> DataFrame:
    """Index rows -> (x, y, pos) pairs of classes, x later, pos the words by which they may differ more than their parity
    bits show; (key, x, y, pos) of rows that were cut short, y their size; the same of all rows in lists above ``hot``. kind: 0, 1, 2. With
    ``ask``, rows have a column ``asked`` and those where it is set meet all earlier ones."""
    names = [x.split()[0] for x in _INDEX.split(", ")] + ["asked"] * ask

    def out(kind: int, key: np.ndarray, x: np.ndarray, y: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(x), kind, np.int32)), pa.array(key), pa.array(x), pa.array(y), pa.array(pos.astype(np.int32))], ["kind", "key", "x", "y", "pos"])

    def pairs(c: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, spare: np.ndarray) -> pa.RecordBatch:
        return out(0, np.zeros(len(x), np.int64), c["cid"][x], c["cid"][y], spare)

    def long(c: dict[str, np.ndarray], leaders: dict[str, np.ndarray] | None) -> Iterator[pa.RecordBatch]:
        """Rows of a list above ``hot``; its leaders, if it began before."""
        both = {k: np.concatenate([leaders[k], c[k]]) for k in c} if leaders else c
        since = len(leaders["key"]) if leaders else 1
        yield pairs(both, *_meet(both, np.zeros(len(both["key"]), np.int64), few, percent, since, lead)[:3])
        yield out(2, c["key"], c["cid"], c["n"].astype(np.int64), c["pos"])

    def solved(c: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        key = c["key"]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(first, len(key)))
        for a, n in zip(first[size > hot], size[size > hot], strict=True):
            yield from long({k: v[a : a + n] for k, v in c.items()}, None)
        keep = np.repeat((size > 1) & (size <= hot), size)
        at = np.repeat(first, size)[keep]
        start = at - (np.cumsum(~keep) - ~keep)[at]
        c = {k: v[keep] for k, v in c.items()}
        if len(start):
            x, y, spare, short = _meet(c, start, few, percent)
            yield pairs(c, x, y, spare)
            yield out(1, c["key"][short], c["cid"][short], c["n"][short].astype(np.int64), c["pos"][short])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        n, leaders = 0, None  # the leaders of a list above ``hot`` that goes on
        for batch in batches:
            c = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in names}
            if leaders:
                more = int(np.searchsorted(c["key"] != leaders["key"][0], True))
                if more:
                    yield from long({k: v[:more] for k, v in c.items()}, leaders)
                c = {k: v[more:] for k, v in c.items()}
            if not len(c["key"]):
                continue
            leaders = None
            held.append(c)
            n += len(c["key"])
            if n < 300_000:
                continue
            c = {k: np.concatenate([x[k] for x in held]) for k in names}
            cut = int(np.searchsorted(c["key"] == c["key"][-1], True))
            if n - cut > hot:
                leaders, cut = {k: v[cut : cut + lead] for k, v in c.items()}, n
            if cut:
                yield from solved({k: v[:cut] for k, v in c.items()})
            held = [{k: v[cut:] for k, v in c.items()}] if cut < n else []
            n -= cut
        if n:
            yield from solved({k: np.concatenate([x[k] for x in held]) for k in names})

    ordered = rows.repartition("key").sortWithinPartitions("key", "id", "line", "r", "cid")
    return ordered.mapInArrow(tidied(run), "kind int, key long, x long, y long, pos int")


def _size_class(percent: int):
    """Sizes of similar sets are in the same or in neighbouring classes: a class spans a little more than their largest ratio."""
    return F.floor(F.ln("n") / (math.log(100 / percent) * (1 + 1e-9))).cast("int")


def _class_of(n: np.ndarray, percent: int) -> np.ndarray:
    """_size_class of sizes in an array."""
    return np.floor(np.log(n) / (math.log(100 / percent) * (1 + 1e-9))).astype(np.int64)


def _asked_slots(key: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """The bits of words and size classes in the bitmap of _asked_bits."""
    with np.errstate(over="ignore"):
        return (mixed(key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + kind.astype(np.uint64)) >> np.uint64(64 - ASKED_BITS)).astype(np.int64)


def _held(bits: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def _asked_bits(asked: DataFrame, percent: int) -> np.ndarray:
    """A bitmap of 2**ASKED_BITS bits, 4 MB whatever the input: the words of ``asked`` (key, n) with the size classes that similar
    sets may have. With very many of them it fills and keeps every row, which costs a shuffle and changes no result."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, kind = batch.column("key").to_numpy(), _class_of(batch.column("n").to_numpy(), percent)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([_asked_slots(key, kind + k) for k in (-1, 0, 1)]) + 1)], ["slot"])

    number, place = (F.call_function(f"bitmap_{x}", F.col("slot")) for x in ("bucket_number", "bit_position"))
    maps = asked.select("key", "n").mapInArrow(tidied(run), "slot long").groupBy(number.alias("block")).agg(F.bitmap_construct_agg(place).alias("map"))
    out = np.zeros(1 << (ASKED_BITS - 12 - 3), "V4096")  # a row for each block of 4096 bytes
    for r in maps.collect():
        out[r["block"] - 1] = bytes(r["map"])
    return out.view(np.uint8)


def _near_asked(rows: DataFrame, asked: DataFrame, percent: int) -> DataFrame:
    """The rows (key, n) of lists that may hold a similar set of one of ``asked`` (key, n): told in the task that makes them, by a
    bitmap, so the rest of a list is neither written nor shuffled."""
    wanted = asked.select("key", F.explode(F.array(*(_size_class(percent) + F.lit(k) for k in (-1, 0, 1)))).alias("size"))
    found = maybe_among(rows, F.xxhash64("key", _size_class(percent)), wanted.select(F.xxhash64("key", "size").alias("near")), name="_near")
    return found.where("_near").drop("_near")


def _split(lists: DataFrame, classes: DataFrame, percent: int, counts) -> DataFrame:
    """(key, x, pos, asked) of lists -> index rows, with ``asked``, under one more word of a prefix that is one longer."""
    rows = lists.select("key", F.col("x").alias("c"), "pos", "asked").join(classes.select("cid", "id", "line", "r", "n", "h"), F.col("c") == F.col("cid"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 4096):
                batch = whole.slice(i, 4096)
                size, pos = batch.column("n").to_numpy().astype(np.int64), batch.column("pos").to_numpy().astype(np.int64)
                start = offsets(size)[:-1]
                _, h, _ = _ordered(batch, counts.value)
                parity = _parity(h, start)
                many = np.maximum(0, np.minimum(size, prefix(size, percent) + 1) - pos - 1)
                at, k = ragged(start + pos + 1, many), np.repeat(np.arange(len(size)), many)
                with np.errstate(over="ignore"):
                    key = mixed(batch.column("key").to_numpy()[k].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + h[at].astype(np.uint64)).view(np.int64)
                take = lambda c: batch.column(c).take(pa.array(k))
                yield pa.RecordBatch.from_arrays([pa.array(key), take("cid"), take("id"), take("line"), take("r"), take("n"), pa.array((at - start[k]).astype(np.int32)), *(m.take(pa.array(k)) for m in parity), take("asked")], [*(x.split()[0] for x in _INDEX.split(", ")), "asked"])

    return rows.mapInArrow(tidied(run), f"{_INDEX}, asked boolean")


def _confirmed(candidates: DataFrame, classes: DataFrame, docs: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """The classes x that are similar to an earlier y, by the words of the lines: (x). The likeliest y of each x is looked
    at first; the others only for the x that are left."""
    pairs = scratch.save(candidates.groupBy("x", "y").agg(F.max("pos").alias("spare")), "pairs")
    wanted = pairs.select(F.col("x").alias("c")).union(pairs.select("y")).distinct()
    wanted = wanted.join(classes.select("cid", "f", "r", "line"), F.col("c") == F.col("cid")).select("cid", F.col("f").alias("wf"), F.col("r").alias("wr"), "line")
    wanted = scratch.save(wanted.groupBy("wf", "wr").agg(F.collect_list(F.struct("line", "cid")).alias("ls")), "wanted")
    some = maybe_among(docs, F.xxhash64("f", "r"), wanted.select(F.xxhash64("wf", "wr").alias("x"))).where("_among").select("f", "r", "text")
    held = some.join(wanted, F.expr("f = wf and r = wr")).select(F.split("text", "\n").alias("parts"), F.explode("ls").alias("l"))
    held = scratch.save(held.select("l.cid", F.element_at("parts", F.col("l.line") + 1).alias("t")), "held")
    best = scratch.save(pairs.groupBy("x").agg(F.max(F.struct("spare", "y")).alias("b")).select("x", F.col("b.y").alias("y")), "best")
    found = scratch.save(_verified(best, held, percent), "confirmed")
    done = found.select(F.col("x").alias("done"))
    others = pairs.select("x", "y").join(done, F.col("x") == F.col("done"), "left_anti")
    others = others.join(best.select(F.col("x").alias("bx"), F.col("y").alias("by")), F.expr("x = bx and y = by"), "left_anti")
    found = scratch.save(found.union(_verified(others, held, percent)), "confirmed")
    scratch.drop(pairs, wanted, held, best)
    return found


def _verified(pairs: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """The x of pairs whose lines (cid, t) are similar."""
    side = lambda s: held.select(F.col("cid").alias(f"{s}c"), F.col("t").alias(f"{s}t"))
    both = pairs.join(side("y"), F.col("y") == F.col("yc")).select("x", "yt").join(side("x"), F.col("x") == F.col("xc")).select("x", "xt", "yt")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for s, t in zip(texts(batch, "xt"), texts(batch, "yt"), strict=True):
                a, b = set(s.lower().split()), set(t.lower().split())
                same = len(a & b)
                ok.append(100 * same >= percent * (len(a) + len(b) - same))
            yield batch.filter(pa.array(ok, pa.bool_())).select(["x"])

    return both.mapInArrow(tidied(run), "x long").distinct()


def matches(docs: DataFrame, percent: int = 80, few: int = FEW, hot: int = HOT, lead: int = LEAD) -> DataFrame:
    """(f, r, line): the removed lines of ``docs`` (id, f, r, text)."""
    scratch = Scratch(docs.sparkSession, "lines")
    heads = scratch.save(_classes(_heads(docs)), "heads")
    classes = heads.where("first")
    slots = lambda b: (np.frombuffer(b"".join(b.column("h").to_pylist()), np.uint32) >> (32 - SLOT_BITS)).astype(np.int64)
    counts = docs.sparkSession.sparkContext.broadcast(slot_counts(classes.select("h"), SLOT_BITS, slots))  # 32 MB at any input
    index = _index(classes, percent, counts)
    met = scratch.save(_met(index, percent, few, hot, lead), "met")
    found = _confirmed(met.where("kind = 0"), classes, docs, percent, scratch)
    done = found.select(F.col("x").alias("done"))
    # rows that were cut short, or met only leaders, and found no match: all others of their lists
    rest = met.where("kind > 0").select("kind", "key", F.col("x").alias("c"), "pos", F.col("y").alias("n")).join(done, F.col("c") == F.col("done"), "left_anti")
    rest = scratch.save(rest, "rest")
    short, long = (rest.where(f"kind = {k}") for k in (1, 2))
    more = []
    if not short.isEmpty():
        # the rest of a list is told where its rows are made, so it leaves no task
        lists = _index(classes, percent, counts, docs.sparkSession.sparkContext.broadcast(_asked_bits(short, percent)))
        lists = lists.join(short.select(F.col("key").alias("k"), "c"), F.expr("key = k and cid = c"), "left")
        more.append(lists.select(*index.columns, F.col("c").isNotNull().alias("asked")))
    if not long.isEmpty():
        asking = scratch.save(_split(long.select("key", F.col("c").alias("x"), "pos", F.lit(True).alias("asked")), classes, percent, counts), "asking")
        lists = _near_asked(met.where("kind = 2").select("key", "x", "pos", F.col("y").alias("n")), long.select("key", "n"), percent)
        split = _split(lists.select("key", "x", "pos", F.lit(False).alias("asked")), classes, percent, counts)
        more += [_near_asked(split, asking.select("key", "n"), percent), asking]
    if more:
        others = scratch.save(_met(reduce(DataFrame.union, more), percent, few, 1 << 62, lead, ask=True).where("kind = 0"), "others")
        found = found.union(_confirmed(others, classes, docs, percent, scratch))
    near = classes.join(found.distinct(), F.col("cid") == F.col("x"), "left_semi").select("f", "r", "line")
    return scratch.save(heads.where("not first").select("f", "r", "line").union(near), "removed")


def dedup(docs: DataFrame, percent: int = 80, few: int = FEW, hot: int = HOT, lead: int = LEAD, removed: str = "_removed") -> DataFrame:
    """The rows of docs with their text but for the removed lines, and a column of the number of these."""
    kept_columns = docs.columns
    docs = stored(docs, Scratch(docs.sparkSession, "lines"))
    f, r, gf, gr, gone, among = unused([*kept_columns, removed], "f", "r", "gf", "gr", "gone", "among")
    keyed = docs.select("*", *(x.alias(n) for x, n in zip(row_key(docs), (f, r), strict=True)))
    known = keyed.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("id"), F.col(f).alias("f"), F.col(r).alias("r"), "text")
    by = matches(known, percent, few, hot, lead).groupBy(F.col("f").alias(gf), F.col("r").alias(gr)).agg(F.collect_list("line").alias(gone))
    rows = maybe_among(keyed, F.xxhash64(f, r), by.select(F.xxhash64(gf, gr).alias("x")), name=among)
    untouched = rows.where(~F.col(among)).withColumn(removed, F.lit(0))
    parts = F.split("text", "\n")
    kept = F.array_join(F.filter(F.transform(parts, lambda t, i: F.when(~F.array_contains(gone, i), t)), lambda t: t.isNotNull()), "\n")
    touched = rows.where(among).join(by, (F.col(f) == F.col(gf)) & (F.col(r) == F.col(gr)), "left")
    touched = touched.withColumn("text", F.when(F.col(gone).isNull(), F.col("text")).otherwise(kept)).withColumn(removed, F.coalesce(F.size(gone), F.lit(0)))
    touched = touched.withColumn(removed, F.greatest(removed, F.lit(0)))
    return untouched.select(*kept_columns, removed).unionByName(touched.select(*kept_columns, removed))


def op8_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(documents(spark, sf_dir))
    text = F.coalesce("text", F.lit(""))
    left = F.size(F.filter(F.split(text, "\n"), lambda t: t.rlike(r"[^\x20\x09-\x0D]")))
    return out.select("doc_id", (left + F.col("_removed")).cast("long").alias("n_lines"), F.col("_removed").cast("long").alias("n_removed"), F.length(text).cast("long").alias("n_chars_kept"), F.sha2(text.cast("binary"), 256).alias("kept_sha256"))
