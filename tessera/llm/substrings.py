"""Operator 9: removal of repeated passages (200 bytes or more) by sorted suffixes.

Only suffixes that can repeat are sorted. Every window of LENGTH bytes has an anchor: its GRAM-byte substring of least hash
(the leftmost). Equal windows have equal anchors at equal places, so windows are compared only where their anchors agree.
Consecutive windows of one anchor form a run; equal runs (by hash of all their bytes) are repeats and are counted before
anything is shuffled, so a passage with very many copies is one row. Runs that share an anchor but differ are sorted:
the bytes around the anchor by deep-shallow sorting - multikey quicksort by eight-byte words to a shallow depth, then a
blind trie for what still agrees - and neighbours in that order tell how far a run's bytes agree with any other's.

Runs are dealt out to the sorter by their anchor and the 85 bytes before it, or the 84 after it, of which each window holds
one. A group of more than HOT runs is dealt out again by half of the bytes that are left, before or after, and so on: a
window holds one of the two halves each time. When no byte is left, the runs of a group have one equal window each.

Cases: a null or empty text and one under LENGTH bytes lose nothing; a null doc_id is kept; repeated rows are copies of
each other, so all their windows go; an empty table gives no rows; further columns are not read. Texts are compared as
UTF-8 bytes, and what is kept may end inside a character.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, documents, mixed, offsets, ragged, texts

LENGTH, GRAM = 200, 32
#: Bytes of a window besides its anchor.
ROOM = LENGTH - GRAM
#: Fills strings up to one length; no UTF-8 text has this byte.
PAD = b"\xff"
SHALLOW, HOT, BLOCK = 32, 2_000, 1 << 20
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of all GRAM-byte substrings, by doubling."""
    h, width, factor = _BYTE[data], 1, 0x100000001B3
    with np.errstate(over="ignore"):
        while width < GRAM:
            h = h[:-width] * np.uint64(factor) + h[width:]
            width, factor = 2 * width, factor * factor % (1 << 64)
    return mixed(h)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return x if done == width else np.minimum(x[: len(x) - (width - done)], x[width - done :])


def runs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, anchor hash, first window, anchor's place after it, windows) of each run; ``data`` has under 2**24 bytes."""
    h = gram_hashes(data)
    low = np.uint64((1 << 24) - 1)
    packed = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    anchor = (_least(packed, LENGTH - GRAM + 1) & low).astype(np.int64)
    inside = np.zeros(len(anchor) + 1, np.int32)
    whole = lengths >= LENGTH
    np.add.at(inside, starts[whole], 1)
    np.add.at(inside, np.minimum(starts[whole] + lengths[whole] - LENGTH + 1, len(anchor)), -1)
    at = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    if not len(at):
        return (np.zeros(0, np.int64),) * 5
    doc = np.searchsorted(starts, at, side="right") - 1
    new = np.ones(len(at), bool)
    new[1:] = (anchor[at[1:]] != anchor[at[:-1]]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    many = np.diff(np.append(first, len(at)))
    lo = at[first]
    return doc[first], h[anchor[lo]], lo, anchor[lo] - lo, many


def _all_runs(docs: DataFrame) -> DataFrame:
    """doc_id, th, k (anchor's hash), s (hash of the run's bytes), lo, d (anchor's place after lo), many (windows)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        for batch in batches:
            raw = texts(batch)
            jobs = [(i, p, min(len(t), p + (1 << 23) + LENGTH - 1)) for i, t in enumerate(raw) if len(t) >= LENGTH for p in range(0, len(t) - LENGTH + 1, 1 << 23)]
            while jobs:
                block, size = [], 0
                while jobs and (not block or size + jobs[-1][2] - jobs[-1][1] <= BLOCK):
                    block.append(jobs.pop())
                    size += block[-1][2] - block[-1][1]
                data = b"".join(raw[i][p:q] for i, p, q in block)
                lengths = np.array([q - p for _, p, q in block], np.int64)
                starts = offsets(lengths)[:-1]
                doc, k, lo, d, many = runs(np.frombuffer(data, np.uint8), starts, lengths)
                view = memoryview(data)
                s = np.fromiter((xxh3_64_intdigest(view[a:b]) for a, b in zip(lo.tolist(), (lo + many + LENGTH - 1).tolist(), strict=True)), np.uint64, len(lo))
                own, base = np.array([i for i, _, _ in block]), np.array([p for _, p, _ in block])
                take = pa.array(own[doc])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(take), batch.column("th").take(take), pa.array(k.view(np.int64)), pa.array(s.view(np.int64)), pa.array(lo - starts[doc] + base[doc]), pa.array(d, pa.int32()), pa.array(many, pa.int32())],
                    ["doc_id", "th", "k", "s", "lo", "d", "many"],
                )

    return docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(run, "doc_id long, th long, k long, s long, lo long, d int, many int")


class BlindTrie:
    """Orders byte strings of one length: descends by branching bytes alone, then one comparison finds the place."""

    def __init__(self, strings: list[bytes]):
        self.strings, self.value = strings, [int.from_bytes(s, "big") for s in strings]
        self.width = len(strings[0])
        self.root: int | list = 0
        for i in range(1, len(strings)):
            self._insert(i)

    def lcp(self, i: int, j: int) -> int:
        x = self.value[i] ^ self.value[j]
        return self.width - (x.bit_length() + 7) // 8

    def _insert(self, i: int) -> None:
        s, path, node = self.strings[i], [], self.root
        while isinstance(node, list):  # [depth, {byte: child}]
            path.append(node)
            node = node[1].get(s[node[0]]) if s[node[0]] in node[1] else next(iter(node[1].values()))
        leaf = node[0] if isinstance(node, tuple) else node
        common = self.lcp(i, leaf)
        if common == self.width:  # equal: shares the leaf
            self._put(path, s, (*node, i) if isinstance(node, tuple) else (node, i))
            return
        above = [n for n in path if n[0] <= common]
        if above and above[-1][0] == common:
            above[-1][1][s[common]] = i
            return
        below = path[len(above)] if len(above) < len(path) else node
        self._put(above, s, [common, {self.strings[leaf][common]: below, s[common]: i}])

    def _put(self, above: list, s: bytes, node) -> None:
        if above:
            above[-1][1][s[above[-1][0]]] = node
        else:
            self.root = node

    def ordered(self) -> list[tuple[int, int]]:
        """(string, bytes that it shares with the string before it), in order."""
        out, stack = [], [(self.root, 0)]
        while stack:
            node, shared = stack.pop()
            if isinstance(node, list):
                for n, b in enumerate(sorted(node[1], reverse=True)):
                    last = n == len(node[1]) - 1
                    stack.append((node[1][b], shared if last else node[0]))
            else:
                leaves = node if isinstance(node, tuple) else (node,)
                out += [(leaf, shared if n == 0 else self.width) for n, leaf in enumerate(leaves)]
        return out


def multikey_quicksort(words: np.ndarray, order: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Sorts ``order`` (rows of ``words``) within the ranges start .. end; returns the ranges whose rows agree in all words.

    Each range is split by a pivot, the median of three of its words at the range's depth, into smaller, equal and larger
    ones; equal ones go on with the next word. All ranges take a step together."""
    deep, depth = [], np.zeros(len(start), np.int64)
    while len(start):
        done = depth == words.shape[1]
        deep += zip(start[done].tolist(), end[done].tolist(), strict=True)
        start, end, depth = start[~done], end[~done], depth[~done]
        if not len(start):
            break
        three = np.stack([words[order[i], depth] for i in (start, (start + end) // 2, end - 1)])
        pivot = np.sort(three, axis=0)[1]
        size = end - start
        at, own = ragged(start, size), np.repeat(np.arange(len(start)), size)
        w = words[order[at], depth[own]]
        part = own * 3 + (w > pivot[own]) + (w >= pivot[own])
        order[at] = order[at][np.argsort(part, kind="stable")]
        many = np.bincount(part, minlength=3 * len(start)).reshape(-1, 3)
        first = start[:, None] + np.cumsum(many, axis=1) - many
        keep = many > 1
        start, end = first[keep], (first + many)[keep]
        depth = (depth[:, None] + np.array([0, 1, 0]))[keep]
    return deep


def deep_shallow(strings: list[bytes], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, shared): strings of one length sorted within their groups, and the bytes that each shares with the one
    before it in order (0 at a group's first). Multikey quicksort by words down to SHALLOW bytes, then blind tries."""
    n = len(strings)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    width = len(strings[0])
    deep = min(SHALLOW, width) // 8
    words = np.array([np.frombuffer(s, ">u8", deep) for s in strings], np.uint64).reshape(n, deep)
    order = np.argsort(group, kind="stable")
    first = np.flatnonzero(np.append(True, group[order[1:]] != group[order[:-1]]))
    last = np.append(first[1:], n)
    several = last - first > 1
    ranges = multikey_quicksort(words, order, first[several], last[several])
    shared, live = np.zeros(n, np.int64), np.ones(n, bool)
    live[first] = False
    for j in range(deep):
        x = words[order[1:], j] ^ words[order[:-1], j]
        same = 8 - sum((x >> np.uint64(8 * k) > 0).astype(np.int64) for k in range(8))
        shared[1:] += np.where(live[1:], same, 0)
        live[1:] &= x == 0
    for a, b in ranges:
        own = order[a:b].copy()
        trie = BlindTrie([strings[i] for i in own]).ordered()
        order[a:b] = own[[i for i, _ in trie]]
        shared[a + 1 : b] = [x for _, x in trie[1:]]
    return order, shared


def _agree(order: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Most bytes that each string shares with any other of its group: with a neighbour in order."""
    best = np.zeros(len(order), np.int64)
    after = np.append(shared[1:], 0)
    best[order] = np.maximum(shared, after)
    return best


def repeated_windows(group: np.ndarray, data: list[bytes], d: np.ndarray, top: np.ndarray, low: np.ndarray) -> list[list[tuple[int, int]]]:
    """For runs that agree on their group's key: the windows that another run of the group has too.

    A window is named by x, the bytes from its start to the anchor; run i has those from low[i] to top[i], and its bytes
    have the anchor at d[i]. Returns ranges (least x, greatest x) for each run."""
    most = LENGTH
    left = [(b[:p][::-1] + PAD * most)[:most] for b, p in zip(data, d.tolist(), strict=True)]
    right = [(b[p:] + PAD * most)[:most] for b, p in zip(data, d.tolist(), strict=True)]
    upper = np.minimum(top, _agree(*deep_shallow(left, group)))
    lower = np.maximum(low, LENGTH - _agree(*deep_shallow(right, group)))
    members: dict[int, list[int]] = {}
    for i, g in enumerate(group.tolist()):
        members.setdefault(g, []).append(i)
    out: list[list[tuple[int, int]]] = [[] for _ in data]
    asked = {(int(group[i]), int(upper[i])) for i in range(len(data)) if upper[i] >= lower[i]}
    reach = upper.copy()
    while asked:  # the suffixes of all runs of a group from x bytes before the anchor on
        rows = [(g, x, i) for g, x in asked for i in members[g] if low[i] <= x <= top[i]]
        if not rows:
            break
        key = np.unique(np.array([(g, x) for g, x, _ in rows], np.int64), axis=0, return_inverse=True)[1].reshape(-1)
        more = max(int(top.max()) - int(low.min()), 0)
        suffix = [(data[i][d[i] - x :] + PAD * (LENGTH + more))[: LENGTH + more] for _, x, i in rows]
        size = [len(data[i]) - int(d[i]) + x for _, x, i in rows]
        got = _agree(*deep_shallow(suffix, key))
        asked = set()
        for (g, x, i), shared, n in zip(rows, got.tolist(), size, strict=True):
            spare = min(shared, n) - LENGTH
            if x == reach[i] and x >= lower[i]:
                if spare >= 0:  # windows that start up to ``spare`` bytes later agree as well
                    end = max(int(lower[i]), x - spare, int(low[i]))
                    out[i].append((end, x))
                    reach[i] = end - 1
                else:
                    reach[i] = x - 1
        for i in range(len(data)):
            if reach[i] >= lower[i]:
                q = (int(group[i]), int(reach[i]))
                asked.add(q)
    return out


def _sorted_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches that are sorted by group -> (doc_id, th, from, to): repeated bytes of runs that occur once."""
    kept: list[tuple] = []

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        group = np.unique(np.array([r[0] for r in rows], np.int64), return_inverse=True)[1].reshape(-1)
        d, top, low = (np.array([r[k] for r in rows], np.int64) for k in (5, 6, 7))
        found = repeated_windows(group, [r[4] for r in rows], d, top, low)
        spans = [(r[1], r[2], r[3] + r[5] - x1, r[3] + r[5] - x0 + LENGTH) for r, f in zip(rows, found, strict=True) if r[8] == 1 for x0, x1 in f]
        cols = list(zip(*spans, strict=True)) or [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "th", "from", "to"])

    for batch in batches:
        rows = list(zip(*(batch.column(c).to_pylist() for c in ("g", "doc_id", "th", "lo", "bytes", "d", "top", "low", "n")), strict=True))
        kept += rows
        cut = next((i for i in range(len(kept) - 1, 0, -1) if kept[i][0] != kept[i - 1][0]), 0)
        if cut and len(kept) > 4000:
            whole, kept = kept[:cut], kept[cut:]
            yield solve(_pairs_only(whole))
    if kept:
        yield solve(_pairs_only(kept))


def _pairs_only(rows: list[tuple]) -> list[tuple]:
    """Without the groups of one run."""
    g = np.array([r[0] for r in rows], np.int64)
    alone = np.ones(len(g), bool)
    alone[1:] &= g[1:] != g[:-1]
    alone[:-1] &= g[:-1] != g[1:]
    return [r for r, a in zip(rows, alone.tolist(), strict=True) if not a]


def repeats(docs: DataFrame, scratch: Scratch, hot: int = HOT) -> DataFrame:
    """(doc_id, th, from, to): ranges of repeated bytes; th is the text's hash. Ranges of a text may overlap."""
    table = scratch.save(_all_runs(docs), "runs")
    rep = F.struct("doc_id", "th", "lo", "d", "many")
    kinds = scratch.save(table.groupBy("k", "s").agg(F.count("*").alias("n"), F.min(rep).alias("rep")), "kinds")
    copied = kinds.where("n > 1").select(F.col("k").alias("ck"), F.col("s").alias("cs"))
    equal = table.join(copied, (F.col("k") == F.col("ck")) & (F.col("s") == F.col("cs")), "left_semi")
    equal = scratch.save(equal.select("doc_id", "th", F.col("lo").alias("from"), (F.col("lo") + F.col("many") + (LENGTH - 1)).alias("to")), "equal")
    scratch.drop(table)
    several = kinds.groupBy(F.col("k").alias("sk")).count().where("count > 1").select("sk")
    unlike = kinds.join(several, F.col("k") == F.col("sk"), "left_semi").select("k", "n", "rep.*")
    unlike = unlike.withColumnsRenamed({"doc_id": "id", "th": "h"})
    texts_ = docs.select("doc_id", F.xxhash64("text").alias("th"), F.col("text").cast("binary").alias("raw"))
    held = texts_.join(unlike, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("th") == F.col("h")))
    held = held.select("doc_id", "th", "k", "n", "lo", "d", F.expr(f"substring(raw, cast(lo + 1 as int), many + {LENGTH - 1})").alias("bytes"), F.col("d").alias("top"), (F.col("d") - F.col("many") + 1).alias("low"))
    dealt = held.select(F.col("k").alias("g"), F.lit(0).alias("a"), F.lit(0).alias("b"), "doc_id", "th", "lo", "bytes", "d", "top", "low", "n")
    out = equal
    while True:
        dealt = scratch.save(_dealt(dealt), "dealt")
        many = scratch.save(dealt.groupBy(F.col("g").alias("hg")).count().where(f"count > {hot}").select("hg"), "hot")
        if many.isEmpty():
            return out.union(_sorted_groups(dealt))
        out = out.union(_sorted_groups(dealt.join(many, F.col("g") == F.col("hg"), "left_anti")))
        dealt = dealt.join(many, F.col("g") == F.col("hg"), "left_semi")
        out = out.union(_equal_windows(dealt.where(f"a + b = {ROOM}")))
        dealt = dealt.where(f"a + b < {ROOM}")


def _dealt(runs_: DataFrame) -> DataFrame:
    """Runs of groups that agree on ``a`` bytes before the anchor and ``b`` after it, dealt out by more of them: windows
    that reach ``m`` bytes before the anchor agree there; the others reach ROOM - m + 1 bytes behind it."""
    m = f"(a + {ROOM} - b) div 2 + 1"
    rows = runs_.withColumn("m", F.expr(m).cast("int"))
    key = lambda side, bytes_: F.xxhash64("g", F.lit(side), F.expr(bytes_)).alias("g")
    after = f"{ROOM} - m + 1"
    left = F.when(F.col("top") >= F.col("m"), F.struct(key(1, "substring(bytes, d - m + 1, m - a)"), F.col("m").alias("a"), F.col("b").alias("b"), F.greatest("low", "m").alias("low"), F.col("top").alias("top")))
    right = F.when(F.col("low") < F.col("m"), F.struct(key(2, f"substring(bytes, d + {GRAM + 1} + b, {after} - b)"), F.col("a").alias("a"), F.expr(after).alias("b"), F.col("low").alias("low"), F.least("top", F.expr("m - 1")).alias("top")))
    part = rows.withColumn("part", F.explode(F.filter(F.array(left, right), lambda x: x.isNotNull())))
    return part.select("part.g", "part.a", "part.b", "doc_id", "th", "lo", "bytes", "d", "part.top", "part.low", "n")


def _sorted_groups(dealt: DataFrame) -> DataFrame:
    return dealt.repartition("g").sortWithinPartitions("g").mapInArrow(_sorted_runs, "doc_id long, th long, `from` long, `to` long")


def _equal_windows(runs_: DataFrame) -> DataFrame:
    """Runs of groups that agree on a whole window: windows that are there twice or more, by 128 bits of hash."""
    w = F.expr(f"substring(bytes, d - a + 1, {LENGTH})")
    windows = runs_.select("doc_id", "th", "n", (F.col("lo") + F.col("d") - F.col("a")).alias("from"), F.xxhash64(F.lit(1), w).alias("w1"), F.xxhash64(F.lit(2), w).alias("w2"))
    many = windows.groupBy(F.col("w1").alias("m1"), F.col("w2").alias("m2")).agg(F.count("*").alias("m")).where("m > 1")
    both = windows.where("n = 1").join(many, (F.col("w1") == F.col("m1")) & (F.col("w2") == F.col("m2")), "left_semi")
    return both.select("doc_id", "th", "from", (F.col("from") + LENGTH).alias("to"))


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def without_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the bytes that remain) of every row."""
    scratch = Scratch(docs.sparkSession, "substrings")
    spans = scratch.save(repeats(docs, scratch, hot), "spans")
    ranges = spans.groupBy(F.col("doc_id").alias("id"), F.col("th").alias("h")).agg(F.collect_set(F.struct("from", "to")).alias("spans"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    rows = rows.join(ranges, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("th") == F.col("h")), "left").select("doc_id", "text", "spans.from", "spans.to")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, many, kept = [], [], [], []
            for t, a, b in zip(texts(batch), batch.column("from").to_pylist(), batch.column("to").to_pylist(), strict=True):
                out, at, gone = [], 0, merged(zip(a or [], b or [], strict=True))
                for x, y in gone:
                    out.append(t[at:x])
                    at = y
                kept.append(b"".join([*out, t[at:]]))
                n.append(len(t))
                removed.append(len(t) - len(kept[-1]))
                many.append(len(gone))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(many, pa.int64()), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op9_deep_shallow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
