import math
import os
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tessera.llm import class_lm


def tokens(t):
    return [*(t or "").encode().lower().split(), b""]


def context_of(spark, pairs, parts=1):
    """CONTEXT rows for {(a, b): n}; a unit's entries in one row, or dealt over ``parts``."""
    e = np.array([(a, b, n) for (a, b), n in pairs.items()] + [(b, -1 - a, n) for (a, b), n in pairs.items()])
    e = e[np.lexsort((e[:, 1], e[:, 0]))]
    rows = class_lm.packed(e[:, 0], e[:, 1], e[:, 2], e[:, 0] % 5 + 5 * (e[:, 1] % parts)).to_pylist()
    return spark.createDataFrame([tuple(r.values()) for r in rows], class_lm.CONTEXT).repartition(2).cache()


def base_scores(docs):
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    c = Counter(w for d, t in docs if d is not None and not held(d) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    for d, t in docs:
        x = tokens(t)
        yield d, held(d), len(x), sum(c[w] > 0 for w in x), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in x)


def check(rows, docs):
    key = lambda r: (str(r[0]), r[2])
    rows = sorted(map(tuple, rows), key=key)
    want = sorted(base_scores(docs), key=key)
    assert [r[:5] for r in rows] == [r[:5] for r in want]
    assert [r[5] for r in rows] == pytest.approx([r[5] for r in want], rel=1e-9)
    assert all(r[6] < 0 and math.isfinite(r[6]) for r in rows)
    return rows


def test_documents(spark):
    d = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{d}/documents.parquet").to_pylist()]
    rows = check(class_lm.op1_class_lm(spark, d).collect(), docs)
    for part in (True, False):  # better than the unigram model, on unseen texts too
        assert sum(r[6] for r in rows if r[1] is part) > 0.98 * sum(r[5] for r in rows if r[1] is part)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(class_lm, "CHUNK_TOKENS", 3)
    docs = [(5, "A b\x0bB"), (5, "A b\x0bB"), (None, "zz b"), (1, None), (2, ""), (3, "b é É " * 50), (2**60, "new")]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, c int")
    check(class_lm.score(df).collect(), docs)
    assert class_lm.score(df.limit(0)).count() == 0
    alone = spark.createDataFrame([(None, "x y")], "doc_id long, text string")
    assert class_lm.score(alone).collect()[0].n_known == 0


def test_exchange_finds_classes_and_raises_likelihood(spark):
    """Two kinds of units that only follow the other kind end up in different classes."""
    rng = np.random.default_rng(0)
    pairs = Counter()
    for _ in range(4000):
        a, b = rng.integers(0, 10), rng.integers(10, 20)
        pairs[a, b] += 1
        pairs[b, rng.integers(0, 10)] += 1
    counts = np.array([sum(n for (a, _), n in pairs.items() if a == u) for u in range(20)])
    context = context_of(spark, pairs)
    f = class_lm._xlogx
    like = lambda m: f(m).sum() - f(m.sum(1)).sum() - f(m.sum(0)).sum()
    _, start = class_lm.cluster(context, 20, counts, classes=4, rounds=0)
    where, m = class_lm.cluster(context, 20, counts, classes=4, rounds=12)
    assert m.sum() == start.sum() == sum(pairs.values()) and like(m) > like(start)
    assert not set(where[:10]) & set(where[10:])


def test_gain_is_the_likelihood_difference():
    rng = np.random.default_rng(1)
    b = rng.integers(0, 9, (7, 7)).astype(float)
    c = np.array([0, 0, 1, 1, 2, 2, 2])

    def table(c):
        m = np.zeros((3, 3))
        np.add.at(m, (c[:, None].repeat(7, 1), c[None].repeat(7, 0)), b)
        return m

    f = class_lm._xlogx
    like = lambda m: f(m).sum() - f(m.sum(1)).sum() - f(m.sum(0)).sum()
    u, o = 4, [0, 1, 2, 3, 5, 6]
    gain = class_lm._gains(2, np.bincount(c[o], b[u, o], 3), np.bincount(c[o], b[o, u], 3), b[u, u], table(c))
    want = [like(table(np.where(np.arange(7) == u, k, c))) for k in range(3)]
    assert np.diff(gain) == pytest.approx(np.diff(want))


def test_model_is_a_distribution():
    """Over known words and one unknown, for any history: emissions of a class and its unknown mass sum to one."""
    c = np.array([5, 3, 1, 2.0])
    room = c.sum() + 0.5 * (len(c) + 1)
    assert ((c + 0.5) / room).sum() + 0.5 / room == pytest.approx(1)


def test_every_word_above_a_fixed_count_is_a_unit(spark):
    """However small its share of the corpus is; rare words have the unit of their longest frequent ending."""
    rows = [("the", 10**9), ("", 10**6)] + [(f"w{i}ing", class_lm.LEAST) for i in range(50)] + [(f"q{i}ed", 4) for i in range(3)] + [("x", 1)]
    frequent, endings, many = class_lm.unit_tables(spark.createDataFrame(rows, "word string, c long"), class_lm.Scratch(spark, "t"))
    units = {r.word: r.unit for r in frequent.collect()}
    assert set(units) == {w for w, c in rows if c >= class_lm.LEAST} and len(set(units.values())) == 52 and units["the"] == 1
    e = {bytes(r.ending): r.unit for r in endings.collect()}
    assert set(e) == {b"ed", b"d", b"x"} and sorted([*units.values(), *e.values()]) == list(range(1, many))
    words = spark.createDataFrame([("q9ed",), ("zd",), ("x",), ("é",)], "word string")
    assert {r.word: r.unit for r in class_lm.by_ending(words, endings).collect()} == {"q9ed": e[b"ed"], "zd": e[b"d"], "x": e[b"x"], "é": 0}


def test_contexts_are_those_of_whole_words(spark, monkeypatch):
    """Each unit's neighbours, against a count of pairs; a unit in several rows moves as one in a single row."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{k}" for k in rng.zipf(1.3, 60) % 40) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found, cluster = [], class_lm.cluster
    monkeypatch.setattr(class_lm, "cluster", lambda c, many, large: (found.append((c.collect(), many, cluster(c, many, large=large))), found[-1][2])[1])
    monkeypatch.setattr(class_lm, "BUCKET", 300)
    monkeypatch.setattr(class_lm, "LARGE", 1)
    class_lm.score(docs).collect()
    monkeypatch.setattr(class_lm, "LARGE", 0.02)
    class_lm.score(docs).collect()
    pairs, units = [], []
    for rows, _, _ in found:
        pairs.append(Counter())
        units.append([])
        for r in rows:
            u, o, n = (np.frombuffer(x, k) for x, k in ((r.u, np.int32), (r.o, np.int32), (r.n, np.int64)))
            pairs[-1].update(dict(zip(zip(u.tolist(), o.tolist()), n.tolist())))
            units[-1] += set(u.tolist())
    held = lambda d: zlib.crc32(str(d).encode()) % 5 == 1
    want = Counter(p for i, t in enumerate(texts) if not held(i) for x in [[b"", *tokens(t)]] for p in zip(x[:-1], x[1:]))
    assert sum(n for (_, o), n in pairs[0].items() if o >= 0) == want.total()
    common = Counter(w for i, t in enumerate(texts) if not held(i) for w in tokens(t))
    assert found[0][1] > sum(c >= class_lm.LEAST for c in common.values())
    assert pairs[0] == pairs[1] and len(units[1]) > len(units[0]) == len(set(units[0]))
    assert (found[0][2][0] == found[1][2][0]).all() and (found[0][2][1] == found[1][2][1]).all()


def test_clustering_goes_on_while_the_likelihood_rises(spark):
    rng = np.random.default_rng(5)
    kind, next_ = rng.integers(0, 8, 160), rng.dirichlet(np.full(8, 0.3), 8)
    members, pairs, a = [np.flatnonzero(kind == k) for k in range(8)], Counter(), 0
    for _ in range(20000):
        b = int(rng.choice(members[rng.choice(8, p=next_[kind[a]])]))
        pairs[a, b] += 1
        a = b
    context = context_of(spark, pairs)
    counts = np.array([sum(n for (x, _), n in pairs.items() if x == u) for u in range(160)])
    f = class_lm._xlogx
    like = lambda m: f(m).sum() - f(m.sum(1)).sum() - f(m.sum(0)).sum()
    where, m = class_lm.cluster(context, 160, counts, classes=8)
    again = np.zeros((8, 8))
    for (x, y), n in pairs.items():
        again[where[x], where[y]] += n
    assert (m == again).all()  # the updates add up to a recount
    few, many = (like(class_lm.cluster(context, 160, counts, classes=8, rounds=r)[1]) for r in (3, 30))
    assert like(m) == many > few


def test_words_of_chunks_leave_the_disk_before_contexts(spark, monkeypatch):
    made, contexts = [], class_lm.contexts

    def watched(rows, *args):
        made.append({p.rsplit("/", 2)[-2] for p in rows.inputFiles() if os.path.exists(p.removeprefix("file://"))} | {d for p in rows.inputFiles() for d in os.listdir(os.path.dirname(os.path.dirname(p.removeprefix("file://"))))})
        return contexts(rows, *args)

    monkeypatch.setattr(class_lm, "contexts", watched)
    docs = spark.createDataFrame([(k, f"a b w{k % 7} a") for k in range(40)], "doc_id long, text string")
    assert class_lm.score(docs).count() == 40 and "kind=0" in made[0] and "kind=1" not in made[0]


def test_chunks_meet_their_counts_in_one_row(spark, monkeypatch):
    """The words of a chunk are shuffled once, not again for its contexts and its scores."""
    made, contexts = [], class_lm.contexts

    def watched(rows, counted, *args):
        made.append((rows.select("own").distinct().count(), counted.collect()))
        return contexts(rows, counted, *args)

    monkeypatch.setattr(class_lm, "contexts", watched)
    monkeypatch.setattr(class_lm, "CHUNK_TOKENS", 30)
    docs = [(k, f"a b w{k % 7} a") for k in range(600)]
    check(class_lm.score(spark.createDataFrame(docs, "doc_id long, text string")).collect(), docs)
    chunks, counted = made[0]
    assert len(counted) == chunks > 1
    assert all(len(r.c) == 2 * len(r.unit) for r in counted)


def test_shuffled_entries_keep_their_values_and_are_small():
    rng = np.random.default_rng(4)
    u = np.sort(rng.zipf(1.2, 200_000) % 50_000)
    o = -1 - rng.integers(0, 50_000, len(u))
    o = o[np.lexsort((o, u))]
    n = np.minimum(rng.zipf(2.5, len(u)), (1 << 31) - 1)
    rows = class_lm.packed(u, o, n, u % 11)
    thin = class_lm.slim(rows)
    assert thin.select(["bucket", "third"]).equals(rows.select(["bucket", "third"]))
    for x, y in zip(class_lm.unslimmed(thin), class_lm.unpacked(rows), strict=True):
        assert x.dtype == y.dtype and (x == y).all()
    lz4 = lambda t: sum(len(pa.compress(x.as_py(), "lz4", asbytes=True)) for c in t.columns[2:] for x in c)
    assert lz4(thin) < 0.75 * lz4(rows)
