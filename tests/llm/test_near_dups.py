import itertools
import random

import numpy as np
import pyarrow.parquet as pq

from pyspark.sql import functions as F

from tessera.llm import near_dups
from tessera.llm.common import Scratch, components


def shingle_set(text, width):
    words = text.lower().split()
    return set(zip(*(words[j:] for j in range(width)))) if len(words) >= width else {tuple(words)} if words else set()


def brute(docs, width):
    """doc_id -> (shingles, component) by comparing all pairs of sets that share a shingle."""
    sets = [(d, shingle_set((t or "").encode(), width)) for d, t in docs]
    root = {d: d for d, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    having = {}
    for i, (_, s) in enumerate(sets):
        for g in s:
            having.setdefault(g, []).append(i)
    for i, j in {p for x in having.values() for p in itertools.combinations(x, 2)}:
        (a, x), (b, y) = sets[i], sets[j]
        if 100 * len(x & y) >= 80 * len(x | y):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return sorted((d, len(s), find(d)) for d, s in sets)


def test_matches_all_pairs_on_documents(spark):
    d = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{d}/documents.parquet").to_pylist()]
    got = near_dups.op10_bottom_k(spark, d).collect()
    want = brute(docs, 2)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len({w[2] for w in want}) < len(want)


def planted(rng):
    """Chains, a large group around one text, short texts and texts of one very common pair."""
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(400))
    docs = []
    base = [word() for _ in range(60)]
    for _ in range(120):
        t = list(base)
        for _ in range(rng.randrange(4)):
            t[rng.randrange(60)] = word()
        docs.append(" ".join(t))
    chain = [word() for _ in range(100)]
    for k in range(30):
        chain = [*chain]
        for j in range(3):
            chain[(k * 3 + j) % 100] = word()
        docs.append(" ".join(chain))
    for _ in range(150):
        docs.append(" ".join([word() for _ in range(rng.randrange(1, 9))]))
    for n in range(1, 40):
        docs.append("is on " * n + " ".join(word() for _ in range(n % 7)))
    docs += ["A  b\tC", "a b c", "a", "A", "", " \n", None, "is on", "is on is"]
    rng.shuffle(docs)
    return list(enumerate(docs, 100))


def test_planted_groups(spark):
    for width in (2, 5):
        docs = planted(random.Random(width))
        got = near_dups.groups(spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, rep string"), width).collect()
        assert sorted(tuple(r) for r in got) == brute(docs, width)


def test_odd_rows(spark):
    rows = [(5, "a b c", 1), (5, "a b c", 1), (None, "a b c", 2), (3, "a b c", 3), (9, "x y z", 4), (9, "a b c", 5), (None, None, 6), (10, "x y z", 7), (2, "", 8), (1, None, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long")
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in near_dups.groups(df, 2).collect())
    assert got == sorted([("5", 2, 3), ("5", 2, 3), ("None", 2, None), ("3", 2, 3), ("9", 2, 3), ("9", 2, 3), ("None", 0, None), ("10", 2, 3), ("2", 0, 2), ("1", 0, 1)])
    kept = near_dups.keep_first(df, 2)
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "None", "None"]
    assert near_dups.groups(df.limit(0)).count() == 0


def test_contained_sets_around_the_sketch_size(spark):
    """Pairs of exactly 80 % and just below it, one set within the other, with the new words the rarest or not."""
    rng, docs = random.Random(4), []
    for n in (*range(196, 264, 4), 205, 255, 256, 257, 300, 319, 320, 321, 400, 640):
        words = [f"{n}w{k}" for k in range(n + 1)]
        rng.shuffle(words)
        small = -(-80 * n // 100)
        docs += [" ".join(words), " ".join(words[: small + 1]), " ".join(words[:small])]
    # words that no other document has are left out of lists, so some are made common
    docs += [" ".join(d.split()[k] for k in range(0, len(d.split()), 7)) for d in docs]
    rows = list(enumerate(docs, 1))
    got = near_dups.groups(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    want = brute(rows, 2)
    assert sorted(tuple(r) for r in got) == want and len({w[2] for w in want}) < len(want) - 30


def test_needed_is_what_sketches_of_similar_sets_share():
    rng, k = random.Random(6), near_dups.K
    for _ in range(300):
        n = rng.randrange(1, 420)
        m = rng.randrange(-(-80 * n // 100), n + 1)
        both = max(-(-80 * (n + m) // 180), 0)
        values = rng.sample(range(10**9), n + m - both)
        a, b = sorted(values[:n]), sorted(values[n - both :])
        shared = len(set(a[:k]) & set(b[:k]))
        assert shared >= min(near_dups.needed(n, 80), near_dups.needed(m, 80))


def test_codes_tell_shingles_apart():
    rng = random.Random(8)
    for width in (1, 2, 5):
        for _ in range(50):
            s, t = (" ".join(rng.choice("abc") for _ in range(rng.randrange(9))).encode() for _ in range(2))
            x, y = near_dups.shingle_codes([s, t], width)
            a, b = (shingle_set(u, width) for u in (s, t))
            assert (len(x), len(y), len(set(x) & set(y))) == (len(a), len(b), len(a & b))


def test_long_chains_take_few_rounds(spark):
    class Counted(Scratch):
        rounds = 0

        def save(self, df, name="t"):
            self.rounds += name == "edges"
            return super().save(df, name)

    for order in (list(range(500)), random.Random(1).sample(range(500), 500)):
        scratch = Counted(spark, "chain")
        links = spark.createDataFrame(list(zip(order, order[1:])), "a long, b long")
        assert components(links, scratch).where("root <> 0").count() == 0 and scratch.rounds <= 10


def test_columns_of_any_name_and_ties_of_a_doc_id(spark):
    names = ["kept", "kept_id", "text_hash", "row_hash", "best", "rep", "n", "component_id", "_among"]
    rows = [(d, t, *(f"{k}{c}" for c in names)) for k, (d, t) in enumerate([(1, "a b c d e f"), (1, "q r s t u v"), (1, "q r s t u v"), (2, "a b c d e f"), (3, "x y z"), (None, "x y z")])]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in names))
    kept = near_dups.keep_first(df)
    once = sorted(map(str, kept.collect()))
    assert kept.columns == df.columns and sorted(map(str, near_dups.keep_first(df.orderBy(F.desc("n")).repartition(3)).collect())) == once
    assert len(once) == 3 and set(once) <= {str(r) for r in df.collect()}


def test_texts_of_megabytes(spark):
    rng = random.Random(9)
    words = [f"w{rng.randrange(10**6)}" for _ in range(400_000)]
    near = [w if rng.random() > 0.03 else "other" for w in words]
    docs = [(4, " ".join(words)), (9, " ".join(near)), (11, " ".join(words[: 200_000]))]
    got = {r.doc_id: r.component_id for r in near_dups.groups(spark.createDataFrame(docs, "doc_id long, text string"), 2).collect()}
    assert got == {4: 4, 9: 4, 11: 11}


def test_texts_that_share_single_shingles_meet_in_few_lists(spark, monkeypatch):
    """Every pair of words stands in five texts or so: lists of single hashes would all have several members."""
    held = {}

    class Counted(Scratch):
        def save(self, df, name="t", by=None):
            out = super().save(df, name, by)
            held[name] = held.get(name, 0) + out.count()
            return out

    monkeypatch.setattr(near_dups, "Scratch", Counted)
    rng = random.Random(12)
    docs = [" ".join(f"w{rng.randrange(150)}" for _ in range(rng.choice((120, 280, 400)))) for _ in range(400)]
    got = near_dups.groups(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), 2).collect()
    assert all(r.doc_id == r.component_id for r in got)
    assert held["lists"] < 4_000  # of 30,000 opened


def test_similar_sketches_share_a_list():
    rng, k = random.Random(13), near_dups.K
    for i in range(600):
        n = rng.randrange(4, 256) if i % 2 else rng.randrange(190, 2000)
        m = rng.randrange(n, 100 * n // 80 + 1)
        both = -(-80 * (n + m) // 180)
        if both > n:
            continue
        values = [rng.getrandbits(64) for _ in range(n + m - both)]
        sets = [np.array(sorted(x), np.uint64) for x in (values[:n], values[n - both :])]
        own, key = near_dups.list_keys(np.concatenate([x[:k] for x in sets]), np.array([n, m]), 80)
        shared = len(set(key[own == 0].tolist()) & set(key[own == 1].tolist()))
        assert n == m == both or shared >= (1 if n < 24 else near_dups.COMMON)


def test_edited_copies_beyond_the_limit_do_not_all_meet(spark, monkeypatch):
    """A group around one text, copies that are too far from it, and copies of its members that are similar to these alone."""
    held = {}

    class Counted(Scratch):
        def save(self, df, name="t", by=None):
            out = super().save(df, name, by)
            held[name] = held.get(name, 0) + out.count()
            return out

    monkeypatch.setattr(near_dups, "Scratch", Counted)
    rng, base, docs = random.Random(15), [f"w{k}" for k in range(100)], []

    def edited(words, many):
        at = set(rng.sample(range(100), many))
        return [f"x{rng.getrandbits(40)}" if k in at else w for k, w in enumerate(words)]

    close = [edited(base, rng.randrange(1, 6)) for _ in range(200)]
    docs = [base, *close, *(edited(base, rng.randrange(6, 12)) for _ in range(150)), *(edited(rng.choice(close), rng.randrange(3, 6)) for _ in range(60))]
    docs += [edited(rng.choice(docs[-60:]), 4) for _ in range(20)]
    rng.shuffle(docs)
    rows = [(k, " ".join(t)) for k, t in enumerate(docs)]
    got = near_dups.groups(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    want = brute(rows, 2)
    assert sorted(tuple(r) for r in got) == want and len({w[2] for w in want}) > 50
    assert held["pairs"] < 10 * len(docs)


def test_prefixes_of_similar_sets_meet():
    """Two similar sets, one of them not similar to their leader: their first differences from it have one in common."""
    rng, seen = random.Random(16), 0
    for _ in range(4000):
        n = rng.randrange(8, 220)
        lead = set(range(n))
        edit = lambda s, k: s - set(rng.sample(sorted(s), min(len(s) - 1, k // 2))) | {rng.randrange(n, 4 * n) for _ in range(k - k // 2)}
        y = edit(lead, rng.randrange(0, n // 3 + 2))
        x = edit(y, rng.randrange(1, n // 6 + 3))
        if 100 * len(x & y) < 80 * len(x | y) or 100 * len(x & lead) >= 80 * len(x | lead) or max(len(x), len(y)) > near_dups.K:
            continue
        seen += 1
        order = lambda s: sorted(s, key=lambda e: (e * 7919) % 10007)
        dx, dy = order(x ^ lead), order(y ^ lead)
        px, py = near_dups.prefixes(len(x), len(dx), n, 80)[0], near_dups.prefixes(len(y), len(dy), n, 80)[1]
        assert set(dx[:px]) & set(dy[:py])
    assert seen > 200
