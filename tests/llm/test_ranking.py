import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from tessera.llm import ranking

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k=20):
    counted = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n, total, df = len(counted), sum(c.total() for _, c in counted), Counter(t for _, c in counted for t in c)
    out = []
    for i, text in items:
        scored = []
        for d, c in counted:
            m, s = 75 + 25 * c.total() * n // total, 0
            for t in TERM.findall((text or "").translate(LOWER)):
                if t in c:
                    s += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
            scored.append((-s, d is not None, d or 0))
        best = [(-s, d if known else None) for s, known, d in sorted(scored) if s < 0][:k]
        out += [(i, r + 1, d, s) for r, (s, d) in enumerate(best)]
    return sorted(out, key=str)


def frames(spark, docs, items):
    return spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, score int").repartition(3), spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, term string").repartition(2)


def got(spark, docs, items, k=20):
    return sorted((tuple(r) for r in ranking.ranked(*frames(spark, docs, items), k=k).collect()), key=str)


@pytest.fixture
def small(monkeypatch):
    """Shards of 40 documents, of which 7 or so are searched together, blocks of 3 items, rounds of 2 entries."""
    for name, value in (("DOCS", 40), ("CELLS", 400), ("ITEMS", 3), ("FIRST", 2), ("LAST", 8)):
        monkeypatch.setattr(ranking, name, value)


def corpus(rng, n, words):
    return [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 5, 30, 200])))) for i in range(n)]


def test_equals_brute_force(spark, small):
    rng = random.Random(2)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(400)]
    docs = corpus(rng, 300, words)
    docs += [(1000 + i, docs[3][1]) for i in range(150)]  # a hot group of equal texts, all ties
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 12)))) for i in range(12)] + [(50, docs[3][1])]
    assert got(spark, docs, items) == brute(docs, items)
    assert got(spark, docs, items, k=3) == brute(docs, items, 3)


def test_odd_rows(spark, small):
    big = "Alpha beta, " * 120_000 + "gamma"
    docs = [(1, "Alpha BETA alpha"), (1, "Alpha BETA alpha"), (None, "alpha beta"), (2, None), (3, ""), (4, " .,;\n"), (5, big), (-7, "ÀÉ straße İX ÀÉ gamma"), (8, "a\x00b 1a2 gamma\x1fdelta")]
    items = [(1, "alpha alpha gamma"), (1, "alpha alpha gamma"), (None, "àÉ B 1A2"), (2, None), (3, "..."), (4, "nowhere"), (5, "ÀÉ x delta"), (6, big)]
    assert got(spark, docs, items) == brute(docs, items)
    assert got(spark, [], items) == [] == got(spark, docs, [])
    assert got(spark, docs[3:5], items[:1]) == []


def test_lists_stop_early_and_miss_nothing():
    """The threshold ends the reading of long lists; ties at the k-th score are decided by id."""
    rng = np.random.default_rng(4)
    n, impact = 3000, []
    doc, term = np.meshgrid(np.arange(n), np.arange(3), indexing="ij")
    impact = np.where(doc < 30, 900_000, rng.integers(1, 400_000, doc.shape))
    ids, weight = rng.permutation(n).astype(np.int64), np.array([5, 1, 3])
    at = ranking.Lists(ids, doc.ravel(), term.ravel(), impact.ravel(), 3)
    scores = impact @ weight
    want = np.lexsort((ids, -scores))[:20]
    docs, s = at.best(np.arange(3), weight, 20, 0)
    assert sorted(zip(docs.tolist(), s.tolist())) == sorted(zip(want.tolist(), scores[want].tolist()))
    looked = []
    forward = at.forward

    class Watched:
        def __getitem__(self, key):
            looked.append(len(key[0]))
            return forward[key]

    at.forward = Watched()
    at.best(np.arange(3), weight, 20, 0)
    assert sum(looked) < n / 4
    assert len(at.best(np.arange(3), weight, 20, int(scores.max()) + 1)[0]) == 0


def test_query_equals_sql(spark):
    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    cursor = con.execute(ranking.SQL)
    df = ranking.op12_threshold(spark, d)
    assert df.columns == [c[0] for c in cursor.description] and [k for _, k in df.dtypes] == ["bigint", "int", "bigint", "bigint"]
    want = sorted(cursor.fetchall())
    assert len(want) == 800 and sorted(tuple(r) for r in df.collect()) == want
