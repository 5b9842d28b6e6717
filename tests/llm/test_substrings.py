import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tessera.llm import substrings

N = substrings.LENGTH


def brute(docs):
    """Every window of every text in one table."""
    raw = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(b[i : i + N] for _, b in raw for i in range(len(b) - N + 1))
    out = []
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - N + 1):
            if seen[b[i : i + N]] > 1:
                gone[i : i + N] = b"\1" * N
        spans = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in df.collect()), key=str)


def planted(rng):
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = [text(rng.randrange(20, 90)) for _ in range(6)]
    docs = [text(30) + rng.choice(passage)[rng.randrange(30) :] + text(20) + rng.choice(passage)[: rng.randrange(100, 400)] for _ in range(60)]
    common = text(25)[:150]  # shared by many, but shorter than a window
    docs += [text(10) + common + text(10) for _ in range(40)]
    edge = text(80)[:260]
    docs += [text(4) + edge[k:] + text(4) for k in range(0, 70, 3)] + [text(4) + edge[: 260 - k] + text(4) for k in range(0, 70, 7)]
    docs += ["a" * n for n in (199, 200, 201, 500)] + ["ab" * 150, "x" + "ab" * 150, "is onhe. " * 60, "", None, text(60), docs[0], docs[0]]
    docs += [chr(0) * 10 + text(50) + chr(0) * 230]
    return list(enumerate(docs))


@pytest.mark.parametrize("hot", [substrings.HOT, 3])
def test_planted_passages(spark, hot):
    docs = planted(random.Random(hot % 1000))
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, kept string")
    assert got(substrings.without_repeats(df, hot)) == brute(docs)


def test_a_text_above_eight_megabytes(spark):
    """It is looked at in parts: a passage across their border is found as well."""
    rng = random.Random(12)
    text = rng.randbytes(9 << 20).hex()[: 9 << 20]
    cut = (8 << 20) - 150
    docs = [(1, text), (2, "-" + text[cut : cut + 300] + "+"), (3, text[5000:5201] + "/"), (4, text[100:299])]
    rows = {r[0]: r[1:4] for r in got(substrings.without_repeats(spark.createDataFrame(docs, "doc_id long, text string")))}
    assert rows == {1: (9 << 20, 501, 2), 2: (302, 300, 1), 3: (202, 201, 1), 4: (199, 0, 0)}


def test_odd_rows(spark):
    rows = [(5, "q" * 150), (5, "q" * 150), (None, None), (7, "z" * 450), (None, "y" * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(substrings.without_repeats(df)) == brute(rows)
    same = [(5, "abcdefgh" * 25 + "x"), (5, "abcdefgh" * 25 + "x"), (None, "k" + "abcdefgh" * 25)]
    assert got(substrings.without_repeats(spark.createDataFrame(same, "doc_id long, text string"))) == brute(same)
    assert substrings.without_repeats(df.limit(0)).count() == 0


def test_documents(spark):
    d = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{d}/documents.parquet").to_pylist()]
    rows = sorted(map(tuple, substrings.op9_deep_shallow(spark, d).collect()), key=str)
    assert rows == brute(docs) and sum(r[2] for r in rows) > 0


def test_groups_of_one_run_only():
    batch = pa.RecordBatch.from_pylist([{"g": 1, "doc_id": 1, "th": 1, "lo": 0, "bytes": b"x" * 220, "d": 3, "top": 3, "low": 0, "n": 1}])
    assert sum(b.num_rows for b in substrings._sorted_runs([batch])) == 0


def test_deep_shallow_order():
    rng = random.Random(3)
    base = [bytes(rng.choice(b"ab") for _ in range(64)) for _ in range(5)]
    strings = [(b[: rng.randrange(64)] + bytes(rng.choice(b"abc") for _ in range(64)))[:64] for b in base for _ in range(60)] + base + base
    group = np.array([i % 3 for i in range(len(strings))])
    order, shared = substrings.deep_shallow(strings, group)
    want = sorted(range(len(strings)), key=lambda i: (group[i], strings[i]))
    assert [(group[i], strings[i]) for i in order] == [(group[i], strings[i]) for i in want]
    for k in range(1, len(order)):
        a, b = strings[order[k - 1]], strings[order[k]]
        n = next((j for j in range(64) if a[j] != b[j]), 64)
        assert shared[k] == (n if group[order[k - 1]] == group[order[k]] else 0)
