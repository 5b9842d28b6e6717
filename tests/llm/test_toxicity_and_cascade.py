import re
import zlib

import numpy as np
import pyarrow.parquet as pq

from tessera.llm import cascade, toxicity

ROWS = [
    (5, "The  CAT\tsat", "b"),
    (5, "The  CAT\tsat", "b"),
    (None, "no id " * 30, None),
    (7, None, "a"),
    (9, "", "a"),
    (1, "word, " * 1500, "é"),
    (2, " ".join(f"w{i}é" for i in range(80)) + "\n# $\n# $\n\n a b c\n a b c", "b"),
    (3, "a b c d a b c a b\n" * 9, "b"),
    (4, " ".join(f"w{i}" for i in range(60)) + " w0 w1 w2 w3 w4", "b"),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "doc_id long, text string, score string")


def auc(score, y):
    order = np.argsort(np.argsort(score, kind="stable"))
    n = y.sum()
    return (order[y == 1].sum() + n - n * (n + 1) / 2) / (n * (len(y) - n))


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in toxicity.op5_compression_toxicity(spark, d).collect()}
    assert len(rows) == pq.read_table(f"{d}/documents.parquet", columns=["doc_id"]).num_rows
    labels = pq.read_table(f"{d}/labels.parquet").to_pylist()
    held = [r for r in labels if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert all(rows[r["doc_id"]].held_out for r in held)
    y, s = np.array([r["toxic"] for r in held]), np.array([rows[r["doc_id"]].score for r in held])
    # nearly half of the toxic labels here are on texts that differ in nothing from ordinary ones
    signs = "idiot scum worthless moron clown loser pathetic disgusting trash stupid".split()
    text = {r["doc_id"]: r["text"].lower() for r in pq.read_table(f"{d}/documents.parquet").to_pylist()}
    marked = np.array([any(w in text[r["doc_id"]] for w in signs) for r in held])
    assert auc(s, marked) > 0.97 and auc(s, y) > 0.75
    assert y[s >= 0.5].mean() > 0.9 and (s >= 0.5)[marked].mean() > 0.85
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows.values())


def test_toxicity_odd_rows(spark):
    labels = spark.createDataFrame([(5, 1), (1, 0), (None, 1), (2, 0), (3, None), (4, 0), (7, 1), (9, 1)], "doc_id long, toxic int")
    got = toxicity.score(frame(spark), toxicity.fit(toxicity.sample(frame(spark), labels))).collect()
    assert len(got) == len(ROWS) and all(0 <= r[toxicity.SCORE] <= 1 for r in got)
    one = toxicity.fit([(b"a", 0), (b"b", 0)])
    assert {round(r[toxicity.SCORE], 6) for r in toxicity.score(frame(spark), one).collect()} == {round(0.5 / 3, 6)}
    assert toxicity.score(frame(spark), toxicity.fit([])).count() == len(ROWS)
    assert toxicity.score(frame(spark, []), one).count() == 0
    kept = toxicity.drop_toxic(frame(spark), labels)
    assert kept.columns == ["doc_id", "text", "score"] and kept.count() <= len(ROWS)


def features(t):
    t = t or ""
    w = re.findall("[^\x20\x09-\x0d]+", t)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    inside = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    seen, dup = set(), 0
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    for x in lines:
        dup += x in seen
        seen.add(x)
    chars, symbols = sum(map(len, w)), len(re.findall("[#*$%&|<>]", t))
    letters = sum(bool(re.search("[A-Za-z]|[^\x00-\x7f]", x)) for x in w)
    n = len(w)
    failed = n < 50 or 100 * len(inside) > 50 * n
    kept = not (failed or not 2 * n <= chars <= 15 * n or 5 * symbols > n or 2 * dup > len(lines) or 10 * letters < 6 * n)
    return (n, chars, symbols, dup, len(inside), failed, kept)


def test_cascade(spark):
    got = [tuple(r) for r in cascade.cascade(frame(spark)).collect()]
    key = lambda r: str(r)
    assert sorted(got, key=key) == sorted([(d, *features(t)) for d, t, _ in ROWS], key=key)
    assert {r[-1] for r in got} == {True, False}
    assert cascade.cascade(frame(spark, [])).count() == 0


def test_cascade_order_and_short_circuit():
    assert cascade.ordered({"a": (0.1, 1e-6), "b": (0.5, 1e-3), "c": (0.5, 1e-6)}, dict.fromkeys("abcd")) == ["c", "a", "b", "d"]
    ran = []
    rules = {"a": lambda v: ran.append("a") or True, "b": lambda v: ran.append("b") or True}
    assert cascade.first_rejection(cascade.View(b"x"), ["b", "a"], rules) == "b" and ran == ["b"]
