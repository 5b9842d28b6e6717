"""Operator 1: a Brown class-based bigram model by exchange clustering, and the texts' probabilities under it.

Words are clustered through units: a word that training holds LEAST times or more is a unit of its own; a rarer one has too
little context and shares the unit of its longest ending (three, two or one byte) that rare words have as often. So the
clustered vocabulary grows with the input, each word has a unit, and no word is left out. Exchange: in turn a third of the
units move to the class that raises the class-bigram likelihood most, given all others (where the moves together do not
raise it, the better half of them, down to the best one); only a round that raises it by less than TOLERANCE of its value
ends the clustering. Which class is best is told exactly for units of more than EXACT neighbours; for rarer ones, which
hardly change the class bigrams themselves, to first order. Whether moves are made is told by the likelihood itself. Class
bigrams are updated from the contexts of the units that move.

Units and contexts stay distributed: units are numbered by frequency in a table; contexts are packed into arrays, a row for
each bucket of units. The units that make up LARGE of all tokens each (1 / LARGE of them at most) have theirs in several
buckets. Class tables (CLASSES squared) and one byte for each unit, its class, are broadcast; moves (17 bytes for each unit
that moves) reach the driver as arrays.

    P(w | h) = MIX * P(class(w) | class(h)) * P(w | class(w)) + (1 - MIX) * base(w)

P(class | class) is smoothed with the classes' shares; an emission is (c + 0.5) / (N_c + 0.5 (V_c + 1)), its last half
the mass of unknown words; an unknown word has the sum of that mass over all classes, so the model is a distribution over
the V known words and one unknown. base is the smoothed unigram estimate.

Exact counts of words reach the tokens without a join of tokens: texts become chunks of word numbers, each chunk's distinct
words are joined to their counts and packed into one row, and each chunk meets its own counts again.

Cases: a null or empty text is one end token; a null doc_id is scored and not learned from; repeated rows count as often as
they occur; an empty table gives no rows; without any training token every word is unknown; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, documents, give_back, mixed, texts, tidied

CLASSES, LEAST, MIX, SHARE = 64, 10, 0.95, 20.0
BUCKET, LARGE, PARTS, EXACT = 250_000, 0.001, 64, 200  # tokens in a bucket, about; see above
CHUNK_TOKENS, TOLERANCE = 1_500_000, 1e-4
END = b""  # no word is empty


class Numbers(dict):
    """word -> number in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def chunks(docs: DataFrame) -> DataFrame:
    """Two kinds of rows: (chunk, doc_id, held, ids) for documents, (chunk, wid, word, c) for a chunk's distinct words."""
    schema = "chunk long, doc_id long, held boolean, ids binary, wid int, word string, c long"
    names = ["chunk", "doc_id", "held", "ids", "wid", "word", "c"]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int32(), pa.string(), pa.int64()]

    def rows(n: int, **have) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([have[c] if c in have else pa.nulls(n, k) for c, k in zip(names, kinds, strict=True)], names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        number, count, tokens = Numbers(), np.zeros(1 << 12, np.int64), 0

        def flush() -> pa.RecordBatch:
            n = len(number)
            return rows(n, chunk=pa.array(np.full(n, chunk)), wid=pa.array(np.arange(n, dtype=np.int32)), word=pa.array(list(number), pa.binary()).cast(pa.string()), c=pa.array(count[:n]))

        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                batch = whole.slice(i, 512)
                held = batch.column("held").to_pylist()
                learn = batch.column("learn").to_pylist()
                got = []
                for t, k in zip(texts(batch), learn, strict=True):
                    x = np.fromiter(map(number.__getitem__, [*t.lower().split(), END]), np.int32)
                    if len(number) > len(count):
                        count = np.concatenate([count, np.zeros(max(len(count), len(number) - len(count)), np.int64)])
                    if k:
                        np.add.at(count, x, 1)
                    tokens += len(x)
                    got.append(x.tobytes())
                yield rows(len(got), chunk=pa.array(np.full(len(got), chunk)), doc_id=batch.column("doc_id"), held=pa.array(held), ids=pa.array(got, pa.binary()))
                if tokens >= CHUNK_TOKENS:
                    yield flush()
                    chunk, number, count, tokens = chunk + 1, Numbers(), np.zeros(1 << 12, np.int64), 0
        if number:
            yield flush()

    rest = held_out(F.col("doc_id"))
    return docs.select("doc_id", rest.alias("held"), (F.col("doc_id").isNotNull() & ~rest).alias("learn"), "text").mapInArrow(tidied(run), schema)


def ending(k: int) -> Column:
    """The last k bytes of a word, null if it is shorter."""
    w = F.col("word").cast("binary")
    return F.when(F.length(w) >= k, F.substring(w, -k, k))


def unit_tables(vocabulary: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame, int]:
    """(word, c, unit) of frequent words, (ending, unit) of the rare ones' endings, and the number of units. They are
    numbered from 1 by frequency; 0 is for words whose endings no rare word has."""
    own = (F.col("c") >= LEAST) | (F.col("word") == "")
    ends = vocabulary.where(~own).select(F.explode(F.array(*(ending(k) for k in (3, 2, 1)))).alias("ending"), "c").where("ending is not null")
    ends = ends.groupBy("ending").agg(F.sum("c").alias("c")).where((F.col("c") >= LEAST) | (F.length("ending") == 1))
    both = vocabulary.where(own).select("word", "c", F.lit(None).cast("binary").alias("ending")).unionByName(ends, allowMissingColumns=True)
    ordered = scratch.save(both.orderBy(F.col("c").desc(), "word", "ending").withColumn("id", F.monotonically_increasing_id()), "ordered")
    part, firsts, many = F.expr("shiftright(id, 33)"), [], 1
    for r in sorted(ordered.groupBy(part.alias("part")).count().collect()):  # a row for each part of the table
        firsts.append((r["part"], many))
        many += r["count"]
    first = F.broadcast(vocabulary.sparkSession.createDataFrame(firsts, "part long, first long"))
    numbered = ordered.join(first, part == F.col("part")).withColumn("unit", F.col("first") + F.expr("id & 8589934591"))
    return numbered.where("word is not null").select("word", "c", "unit"), numbered.where("ending is not null").select("ending", "unit"), many


def by_ending(words: DataFrame, endings: DataFrame) -> DataFrame:
    """``words`` with ``unit``, that of each one's longest known ending."""
    kept = words.columns
    for k in (3, 2, 1):
        e = endings.where(F.length("ending") == k).select(F.col("ending").alias(f"_e{k}"), F.col("unit").alias(f"_u{k}"))
        words = words.join(e if k == 3 else F.broadcast(e), ending(k) == F.col(f"_e{k}"), "left")  # 256 and 65,536 rows at most
    return words.select(*kept, F.coalesce("_u3", "_u2", "_u1", F.lit(0)).alias("unit"))


def third(u: np.ndarray) -> np.ndarray:
    """The turn in which a unit moves."""
    return ((u.astype(np.uint64) * np.uint64(2654435761) >> np.uint64(8)) % np.uint64(3)).astype(np.int64)


CONTEXT = "bucket long, third long, u binary, o binary, n binary"


def packed(u: np.ndarray, o: np.ndarray, n: np.ndarray, bucket: np.ndarray) -> pa.Table:
    """Rows of CONTEXT, a row for each bucket and third, for entries of units u: others o (the unit after as it is, one before
    as -1 - unit), counts n. Entries of a row keep their order."""
    group = bucket * 3 + third(u)
    order = np.argsort(group.astype(np.uint16) if len(group) and group.max() < 1 << 16 else group, kind="stable")  # by digits if it can
    group = group[order]
    cut = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(group))
    first = group[cut[:-1]]
    kinds = (u[order].astype(np.int32), o[order].astype(np.int32), n[order].astype(np.int64))
    blobs = [pa.array([x[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()) for x in kinds]
    return pa.table([pa.array(first // 3), pa.array(first % 3), *blobs], names=["bucket", "third", "u", "o", "n"])


SLIM = "bucket long, third long, e binary"


def slim(t: pa.Table) -> pa.Table:
    """CONTEXT rows whose entries are in order of their units, as they are shuffled: what u grows by, o and n, byte by byte of their
    32 bits, so that equal bytes stand together and the shuffle's compression finds them."""
    out = []
    for kinds in zip(t.column("u"), t.column("o"), t.column("n"), strict=True):
        u, o, n = (np.frombuffer(x.as_py(), k) for x, k in zip(kinds, (np.int32, np.int32, np.int64), strict=True))
        e = np.stack([np.diff(u, prepend=np.int32(0)), o, n.astype(np.int32)])  # a chunk's counts are below 2**31
        out.append(e.view(np.uint8).reshape(3, -1, 4).transpose(0, 2, 1).tobytes())
    return pa.table([t.column("bucket"), t.column("third"), pa.array(out, pa.binary())], names=["bucket", "third", "e"])


def unslimmed(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(u, o, n): all entries of SLIM rows."""
    each = [np.ascontiguousarray(np.frombuffer(x.as_py(), np.uint8).reshape(3, 4, -1).transpose(0, 2, 1)).view(np.int32)[..., 0] for x in t.column("e")]
    u, o, n = (np.concatenate([x[i] for x in each]) for i in range(3))
    many = np.array([x.shape[1] for x in each])
    upto = np.cumsum(u, dtype=np.int64)
    start = np.cumsum(many) - many
    return (upto - np.repeat(upto[start] - u[start], many)).astype(np.int32), o, n.astype(np.int64)


def unpacked(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(u, o, n): all entries of a batch of CONTEXT rows."""
    kinds = {"u": np.int32, "o": np.int32, "n": np.int64}
    return tuple(np.frombuffer(b"".join(batch.column(c).to_pylist()), kind) for c, kind in kinds.items())


def contexts(rows: DataFrame, counted: DataFrame, many: int, total: int, large: list[int], scratch: Scratch) -> DataFrame:
    """CONTEXT rows: each unit's neighbours and their counts, in one row but for the large ones."""
    buckets, split = 1 + total // BUCKET, np.array(large, np.int64)

    def run(d: pa.Table, v: pa.Table) -> pa.Table:
        give_back()  # of the chunk before; the worker goes on with the next
        none = np.zeros(0, np.int64)
        if not d.num_rows:
            return slim(packed(none, none, none, none))
        unit = np.frombuffer(v.column("unit")[0].as_py(), np.int32).astype(np.int64)
        x = np.concatenate([np.frombuffer(ids.as_py(), np.int32) for ids in d.column("ids")])  # each text ends with END
        x = unit[np.concatenate([x[-1:], x])]
        code = np.sort(x[:-1] * many + x[1:])
        first = np.flatnonzero(np.diff(code, prepend=-1))
        n = np.diff(np.append(first, len(code)))
        code = code[first]
        a, b = code // many, code % many
        out = []
        back = np.argsort(b * many + a)
        for u, o, n in ((a, b, n), (b[back], -1 - a[back], n[back])):
            part = np.where(np.isin(u, split), o % PARTS, 0)
            out.append(slim(packed(u, o, n, (mixed((u * PARTS + part).astype(np.uint64)) % np.uint64(buckets)).astype(np.int64))))
        return pa.concat_tables(out)

    def merged(key: tuple, g: pa.Table) -> pa.Table:
        give_back()
        u, o, n = unslimmed(g)
        order = np.argsort((u.astype(np.int64) << 32) + o)
        u, o, n = u[order], o[order], n[order]
        first = np.flatnonzero((np.diff(u, prepend=-1) != 0) | (np.diff(o, prepend=np.int32(0)) != 0) | (np.arange(len(u)) == 0))
        u, o, n = u[first], o[first], np.add.reduceat(n, first)
        return packed(u, o, n, np.full(len(u), key[0].as_py()))

    learn = rows.where(F.col("doc_id").isNotNull() & ~F.col("held")).select("own", "ids")
    found = learn.groupBy("own").cogroup(counted.select("chunk", "unit").groupBy("chunk")).applyInArrow(run, SLIM)
    return scratch.save(found.groupBy("bucket", "third").applyInArrow(merged, CONTEXT), "contexts", "third", codec="zstd")


def by_chunk(counted: DataFrame) -> DataFrame:
    """(chunk, c, unit): the counts and units of a chunk's words, by their numbers, in one row of arrays."""

    def run(key: tuple, g: pa.Table) -> pa.Table:
        wid = g.column("wid").to_numpy()
        c, unit = np.zeros(len(wid), np.int64), np.zeros(len(wid), np.int32)
        c[wid], unit[wid] = g.column("c").to_numpy(), g.column("unit").to_numpy()
        return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([c.tobytes()], pa.binary()), pa.array([unit.tobytes()], pa.binary())], names=["chunk", "c", "unit"])

    return counted.groupBy("chunk").applyInArrow(run, "chunk long, c binary, unit binary")


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def _gains_of(own: np.ndarray, after: np.ndarray, before: np.ndarray, itself: np.ndarray, m: np.ndarray) -> np.ndarray:
    """_gains for several units, a row each; only cells that a unit has count."""
    u, k = after.shape
    each, gain = np.arange(u), np.zeros((u, k))
    for x, y, t in ((after, before, m), (before, after, m.T)):
        at, j = np.nonzero(x)
        if not len(at):
            continue
        v, o, i = x[at, j], own[at], np.arange(len(at))
        cells, was = t.T[j], _xlogx(t.T)[j]  # a column of t for each cell
        s = np.flatnonzero(j == o)
        cells[i, o] -= v
        cells[s] -= y[at[s]]
        cells[s, o[s]] -= itself[at[s]]
        was[s] = _xlogx(cells[s])
        was[i, o] = _xlogx(cells[i, o])
        first = np.flatnonzero(np.diff(at, prepend=-1))
        gain[at[first]] += np.add.reduceat(_xlogx(cells + v[:, None]) - was, first)
    a, b = after.sum(1) + itself, before.sum(1) + itself
    d, rows, cols = (np.repeat(x[None], u, 0) for x in (m.diagonal(), m.sum(1), m.sum(0)))
    d[each, own] -= after[each, own] + before[each, own] + itself
    rows[each, own] -= a
    cols[each, own] -= b
    gain += _xlogx(d + after + before + itself[:, None]) - _xlogx(d + after) - _xlogx(d + before) + _xlogx(d)
    return gain - _xlogx(rows + a[:, None]) + _xlogx(rows) - _xlogx(cols + b[:, None]) + _xlogx(cols)


def _gains(own: int, after: np.ndarray, before: np.ndarray, itself: float, m: np.ndarray) -> np.ndarray:
    """Log-likelihood, up to a constant, of putting a unit into each class. after / before: its counts by the class of
    the next / last unit, without itself; own: its class, which it leaves first; m: class bigrams."""
    return _gains_of(np.array([own]), after[None].astype(float), before[None].astype(float), np.array([itself], float), m)[0]


def _first_order(own: np.ndarray, profile: np.ndarray, m: np.ndarray) -> np.ndarray:
    """_gains_of to first order in the units' counts, a matrix product; profile as in _best."""
    k, each = len(m), np.arange(len(own))
    after, before, itself = profile[:, :k], profile[:, k:-1], profile[:, -1]
    log = np.log(m + 1)
    rows, cols, a, b = m.sum(1), m.sum(0), after.sum(1) + itself, before.sum(1) + itself
    gain = after @ log.T + before @ log + itself[:, None] * log.diagonal()
    gain -= a[:, None] * np.log(rows + 1) + b[:, None] * np.log(cols + 1)
    stay = (after * np.log(np.maximum(m[own] - after, 0) + 1)).sum(1) + (before * np.log(np.maximum(m.T[own] - before, 0) + 1)).sum(1)
    stay += itself * np.log(np.maximum(m[own, own] - itself, 0) + 1)
    gain[each, own] = stay - a * np.log(np.maximum(rows[own] - a, 0) + 1) - b * np.log(np.maximum(cols[own] - b, 0) + 1)
    return gain


def _best(u: np.ndarray, own: np.ndarray, profile: np.ndarray, m: np.ndarray) -> list[np.ndarray]:
    """(units, classes, gains) of units that another class is better for. profile: after, before and itself in a row."""
    k, out = len(m), []
    often = profile.sum(1) > EXACT
    for exact, those, step in ((True, np.flatnonzero(often), 500), (False, np.flatnonzero(~often), 20_000)):
        for i in range(0, len(those), step):
            at = those[i : i + step]
            p, c = profile[at], own[at]
            gain = _gains_of(c, p[:, :k], p[:, k:-1], p[:, -1], m) if exact else _first_order(c, p, m)
            best, each = gain.argmax(1), np.arange(len(c))
            more = gain[each, best] - gain[each, c]
            up = np.flatnonzero(more > 1e-6)
            out.append((u[at[up]], best[up], more[up]))
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]


def cluster(context: DataFrame, many: int, counts: np.ndarray | None = None, classes: int = CLASSES, rounds: int | None = None, large: Iterable[int] = ()) -> tuple[np.ndarray, np.ndarray]:
    """(class of each unit, class bigram counts) from CONTEXT rows; ``large`` units may be in several. Units start in classes by frequency rank; without ``counts`` their
    numbers are their ranks. Without ``rounds`` the clustering ends when one raises the likelihood by less than TOLERANCE."""
    sc = context.sparkSession.sparkContext
    where = np.zeros(many, np.uint8 if classes <= 256 else np.int64)
    where[np.arange(many) if counts is None else np.argsort(-counts, kind="stable")] = np.arange(many) % classes
    thirds, split = [context.where(F.col("third") == turn) for turn in range(3)], np.array(sorted(large), np.int64)

    def changed(rows: DataFrame, old: np.ndarray, new: np.ndarray | None) -> np.ndarray:
        """Class bigrams with ``old``; or with ``new``, the difference, from the contexts of the units it moves."""
        shared = sc.broadcast((old, new))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            (c, to), m = shared.value, np.zeros(classes * classes)
            for batch in batches:
                u, o, n = unpacked(batch)
                if to is None:
                    s = o >= 0
                    m += np.bincount(c[u[s]].astype(np.int64) * classes + c[o[s]], n[s], classes * classes)
                    continue
                next_, w = o >= 0, np.where(o >= 0, o, -1 - o)
                # a pair of two that move counts once, with its first
                s = (c[u] != to[u]) & (next_ | (c[w] == to[w]))
                next_, u, w, n = next_[s], u[s], w[s], n[s]
                a, b = np.where(next_, u, w), np.where(next_, w, u)
                for k, sign in ((to, 1), (c, -1)):
                    m += sign * np.bincount(k[a].astype(np.int64) * classes + k[b], n, classes * classes)
            at = np.flatnonzero(m)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.rint(m[at]).astype(np.int64))], ["cell", "n"])

        m = np.zeros(classes * classes)
        for r in rows.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
            m[r["cell"]] = r["n"]
        shared.unpersist()
        return m.reshape(classes, classes)

    def better(c: np.ndarray, m: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
        """Units and the classes they gain most in, the largest gain first."""
        shared = sc.broadcast((c, m))
        width = 2 * classes + 1

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c, m = shared.value
            for batch in batches:
                u, o, n = unpacked(batch)
                if not len(u):
                    continue
                new = np.diff(u, prepend=-1) != 0  # a row's entries are in order of their units
                units, row, next_ = u[new].astype(np.int64), np.cumsum(new) - 1, o >= 0
                w = np.where(next_, o, -1 - o)
                itself = u == w
                cell = np.where(itself, width - 1, np.where(next_, 0, classes) + c[w])
                s = next_ | ~itself
                profile = np.bincount(row[s] * width + cell[s], n[s], len(units) * width).reshape(-1, width)
                whole = ~np.isin(units, split)
                u, k, gain = _best(units[whole], c[units[whole]].astype(np.int64), profile[whole], m)
                rest = [x.tobytes() for x in profile[~whole]]
                cols = [[*u, *units[~whole]], [*k, *[0] * len(rest)], [*gain, *[0.0] * len(rest)], [*[None] * len(u), *rest]]
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds, strict=True)], ["u", "k", "gain", "profile"])

        got = thirds[turn].mapInArrow(run, "u long, k long, gain double, profile binary").toArrow()
        shared.unpersist()
        part = np.array(got.column("profile").is_valid(), bool)
        u, k, gain = (got.column(x).to_numpy() for x in ("u", "k", "gain"))
        large, at = np.unique(u[part], return_inverse=True)  # those in several rows: their sum
        profile = np.zeros((len(large), width))
        for i, x in zip(at, got.column("profile").drop_null(), strict=True):
            profile[i] += np.frombuffer(x.as_py())
        more = _best(large, c[large].astype(np.int64), profile, m)
        u, k, gain = (np.concatenate([x[~part], y]) for x, y in zip((u, k, gain), more, strict=True))
        order = np.lexsort((u, -gain))
        return u[order], k[order]

    likelihood = lambda m: _xlogx(m).sum() - _xlogx(m.sum(1)).sum() - _xlogx(m.sum(0)).sum()
    m = changed(context, where, None)
    for _ in count() if rounds is None else range(rounds):
        before, moved = likelihood(m), 0
        for turn in range(3):
            units, to = better(where, m, turn)
            while len(units):  # moves that together undo each other: the better half of them, down to the best one
                after = where.copy()
                after[units] = to
                next_ = m + changed(thirds[turn], where, after)
                if likelihood(next_) > likelihood(m):
                    where, m, moved = after, next_, moved + 1
                    break
                units, to = units[: len(units) // 2], to[: len(units) // 2]
        if not moved or likelihood(m) - before < TOLERANCE * abs(before):
            break
    return where, m


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    scratch = Scratch(docs.sparkSession, "lm")
    spark = docs.sparkSession
    table = scratch.save(chunks(docs).withColumn("kind", F.when(F.col("word").isNull(), 0).otherwise(1)), "chunks", "kind", at_once=2)
    words = table.where("kind = 1").select("chunk", "wid", "word", "c")
    vocabulary = scratch.save(words.groupBy("word").agg(F.sum("c").alias("c")).where("c > 0"), "vocabulary")
    total, known = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    frequent, endings, many = unit_tables(vocabulary, scratch)
    rare = vocabulary.where((F.col("c") < LEAST) & (F.col("word") != ""))
    placed = scratch.save(frequent.unionByName(by_ending(rare, endings)), "placed")
    scratch.drop(vocabulary)
    # a word that training lacks has the class of its ending as history for the next
    joined = words.drop("c").join(placed.select(F.col("word").alias("pw"), "c", "unit"), F.col("word") == F.col("pw"), "left").drop("pw")
    lost = by_ending(joined.where("c is null").select("chunk", "wid", "word", F.lit(0).cast("long").alias("c")), endings)
    numbered = scratch.save(joined.where("c is not null").select("chunk", "wid", "c", "unit").unionByName(lost.drop("word")), "numbered")
    scratch.drop(table, part="kind=1")  # the words are numbers from here on
    counted = scratch.save(by_chunk(numbered), "counted", codec="zstd")
    scratch.drop(numbered)
    rows = table.where("kind = 0").select(F.col("chunk").alias("own"), "doc_id", "held", "ids")
    large = [r["unit"] for r in placed.groupBy("unit").agg(F.sum("c").alias("c")).where(F.col("c") > LARGE * (total or 0)).collect()]  # 1 / LARGE at most
    context = contexts(rows, counted, many, total or 0, large, scratch)
    where, m = cluster(context, many, large=large)
    scratch.drop(context)
    shared = spark.sparkContext.broadcast(where)  # a byte for each unit

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, v, k = np.zeros(CLASSES), np.zeros(CLASSES, np.int64), np.arange(CLASSES)
        for batch in batches:
            kind = shared.value[batch.column("unit").to_numpy()]
            c += np.bincount(kind, batch.column("c").to_numpy(), CLASSES)
            v += np.bincount(kind, minlength=CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c.astype(np.int64)), pa.array(v)], ["k", "c", "v"])

    tokens, distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in placed.mapInArrow(sums, "k long, c long, v long").groupBy("k").agg(F.sum("c").alias("c"), F.sum("v").alias("v")).collect():
        tokens[r["k"]], distinct[r["k"]] = r["c"], r["v"]
    share = (tokens + 1e-9) / (tokens.sum() + 1e-9 * CLASSES)
    room = tokens + 0.5 * (distinct + 1)
    step = (m + SHARE * share) / (m.sum(1, keepdims=True) + SHARE)
    whole = total + 0.5 * (known + 1)
    parts = spark.sparkContext.broadcast({"where": where, "room": room, "step": step, "none": step @ (0.5 / room)})

    def scored(d: pa.Table, v: pa.Table) -> pa.Table:
        p = parts.value
        c = np.frombuffer(v.column("c")[0].as_py(), np.int64).astype(float)
        kind = p["where"][np.frombuffer(v.column("unit")[0].as_py(), np.int32)]
        base = (c + 0.5) / whole
        emit = (c + 0.5) / p["room"][kind]
        log_base = np.log10(base)
        out = []
        for ids in d.column("ids"):
            x = np.frombuffer(ids.as_py(), np.int32)
            k, have = kind[x], c[x] > 0
            last = np.concatenate([k[-1:], k[:-1]])  # its last token is END, which is before its first too
            by_class = np.where(have, p["step"][last, k] * emit[x], p["none"][last])
            out.append((len(x), int(have.sum()), float(log_base[x].sum()), float(np.log10(MIX * by_class + (1 - MIX) * base[x]).sum())))
        cols = [np.array(x) for x in zip(*out, strict=True)]
        return pa.table([d.column("doc_id"), d.column("held"), pa.array(cols[0]), pa.array(cols[1]), pa.array(np.full(len(out), total)), pa.array(cols[2]), pa.array(cols[3])], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.groupBy("own").cogroup(counted.groupBy("chunk")).applyInArrow(scored, out)


def op1_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))
