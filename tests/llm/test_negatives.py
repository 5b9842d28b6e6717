import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.llm import negatives


def brute(rows, step, positives=5, negatives_=5, lower=80, upper=100, scale=256):
    ok = [(i, lab, [max(min(math.floor(scale * x), 1 << 26), -(1 << 26)) for x in v]) for i, lab, v in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, lab, v in ok:
        if i % step:
            continue
        scored = sorted((-dot(v, u), j, other) for j, other, u in ok)
        near = [(-s, j) for s, j, other in scored if other == lab and j != i][:positives]
        for s, j in near:
            hard = [(-t, k) for t, k, other in scored if other != lab and lower * s <= -100 * t <= upper * s][:negatives_]
            out += [(i, j, r + 1, k, s, t) for r, (t, k) in enumerate(hard)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, lab, v, 7) for i, lab, v in rows], "vec_id long, label int, embedding array<float>, top int").repartition(3)


def mined(df, step, **k):
    return sorted(tuple(r) for r in negatives.mine(df, F.col("id") % step == 0, **k).collect())


@pytest.fixture
def small(monkeypatch):
    """Buckets of 16 rows, blocks of 4 anchors and three windows at once, so waves, pruning and cuts all occur."""
    for name, value in (("BUCKET", 16), ("BLOCK", 4), ("HELD", 3)):
        monkeypatch.setattr(negatives, name, value)


def test_equals_brute_force(spark, small):
    rng = random.Random(5)
    vector = lambda size: [rng.gauss(0, 1) * size / 4 for _ in range(8)]
    rows = [(i, rng.randrange(3), vector(rng.choice([0.01, 0.3, 1, 1, 4]))) for i in range(300)]
    same = [(1000 + i, 1, rows[0][2]) for i in range(90)]  # a hot group: the same vector and label
    other = [(2000 + i, 2, [x * 0.9 for x in rows[0][2]]) for i in range(60)]
    df = frame(spark, rows + same + other)
    assert mined(df, 10) == brute([(i, lab, list(v)) for i, lab, v, _ in df.collect()], 10)
    assert mined(df, 50, positives=2, negatives=7, lower=50, upper=130, scale=16) == brute([tuple(r)[:3] for r in df.collect()], 50, 2, 7, 50, 130, 16)


def test_odd_rows(spark, small):
    v, nan, inf = [0.5, -0.25, 1.0], float("nan"), float("inf")
    rows = [(0, 1, v), (1, 1, v), (2, 2, v), (2, 2, v), (3, 2, [0.45, -0.2]), (4, 2, []), (5, None, v), (None, 1, v), (6, 1, None), (7, 1, [0.5, None, 1.0]), (8, 2, [nan, 1.0, 1.0]), (9, 2, [inf, 0.0, 0.0])]
    rows += [(10, 2, [0.0, 0.0, 0.0]), (20, 1, [0.0]), (30, 1, [3e38, 1.0, 0.0]), (31, 2, [3e38, -3e38]), (32, 1, [-1.0, 0.0, 0.0]), (0, 1, [0.5, -0.25, 0.9]), (0, 2, v)]
    df = frame(spark, rows)
    got = mined(df, 10)
    assert got == brute([tuple(r)[:3] for r in df.collect()], 10)
    assert any(r[5] > 1 << 51 for r in mined(frame(spark, [*rows, (33, 2, [3e38]), (34, 1, [3e38, 2.0])]), 10))
    for empty in (df.where("false"), df.where("vec_id = 1"), df.where("label = 2")):
        assert mined(empty, 10) == brute([tuple(r)[:3] for r in empty.collect()], 10)


def test_pruning_reads_few_buckets(spark, small, monkeypatch):
    """Long vectors first: their scores end the search before the short ones are read."""
    rows = [(i, i % 2, [10.0 - i / 100, 1.0] if i < 60 else [0.1, 0.0]) for i in range(600)]
    read, ranked = [], negatives.Index.ranked
    monkeypatch.setattr(negatives.Index, "ranked", lambda self, low, high: read.append((low, high, self.total)) or ranked(self, low, high))
    df = frame(spark, [r for r in rows if r[0] % 20 or r[0] < 60])
    assert mined(df, 20) == brute([tuple(r)[:3] for r in df.collect()], 20)
    assert max(high for _, high, _ in read) < read[0][2] / 2


def test_query_equals_sql(spark):
    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{d}/embeddings.parquet'")
    cursor = con.execute(negatives.SQL)
    names = [c[0] for c in cursor.description]
    df = negatives.op13_norm_buckets(spark, d)
    assert df.columns == names and dict(df.dtypes)["rank"] == "int"
    want = sorted(cursor.fetchall())
    assert len(want) > 20 and sorted(tuple(r) for r in df.collect()) == want
