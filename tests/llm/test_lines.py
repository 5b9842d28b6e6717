import hashlib
import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from tessera.llm import lines


def brute(docs):
    """(doc_id, text) in table order -> (lines, removed, text) by comparing each line with all earlier ones."""
    parts = [(t or "").split("\n") for _, t in docs]
    order = sorted((d is None, d or 0, j, i) for i, (d, _) in enumerate(docs) for j in range(len(parts[i])))
    seen, having, gone, n = [], {}, set(), [0] * len(docs)
    for _, _, j, i in order:
        s = frozenset(parts[i][j].encode().lower().split())
        if not s:
            continue
        n[i] += 1
        if any(100 * len(s & seen[k]) >= 80 * len(s | seen[k]) for k in {k for w in s for k in having.get(w, ())}):
            gone.add((i, j))
        for w in s:
            having.setdefault(w, []).append(len(seen))
        seen.append(s)
    kept = lambda i: "\n".join(x for j, x in enumerate(parts[i]) if (i, j) not in gone)
    return [(n[i], sum(k == i for k, _ in gone), None if t is None else kept(i)) for i, (_, t) in enumerate(docs)]


def test_documents(spark):
    d = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{d}/documents.parquet").to_pylist()]
    got = {r.doc_id: tuple(r)[1:] for r in lines.op8_prefix_join(spark, d).collect()}
    want = {k: (n, g, len(t), hashlib.sha256(t.encode()).hexdigest()) for (k, _), (n, g, t) in zip(docs, brute(docs))}
    assert got == want and sum(g for _, g, _, _ in want.values()) > 0


def planted(rng, most=50):
    word = lambda: rng.choice("abcdefg") + str(rng.randrange(90))
    base = [[word() for _ in range(rng.randrange(1, most))] for _ in range(12)]
    docs = []
    for _ in range(80):
        text = []
        for _ in range(rng.randrange(6)):
            x = list(rng.choice(base)) if rng.random() < 0.7 else [word() for _ in range(rng.randrange(1, max(2, most * 3 // 5)))]
            for _ in range(rng.randrange(4)):
                x[rng.randrange(len(x))] = word()
            text.append(rng.choice(["", " ", "A "]) + " ".join(x))
        docs.append("\n".join(text))
    docs += [None, "", "\n\n", "The same line here\nthe SAME line here", "is on is on", "is on", docs[0]]
    ids = list(range(len(docs)))
    rng.shuffle(ids)
    return [(i if i != 3 else None, t) for i, t in zip(ids, docs)] + [(ids[0], docs[0])]


@pytest.mark.parametrize(("few", "hot", "lead"), [(lines.FEW, lines.HOT, lines.LEAD), (1, 3, 1)])
def test_planted_lines(spark, tmp_path, few, hot, lead):
    """Also with one partner for a line, and with lists that are split by a second word."""
    docs = planted(random.Random(5))
    rows = [(d, t, k, 1, 2, "x", "y", 3, 4, 5) for k, (d, t) in enumerate(docs)]
    spark.createDataFrame(rows, "doc_id long, text string, line int, n int, r int, _rid string, _gone string, _among int, f int, x int").coalesce(1).write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    out = lines.dedup(df, few=few, hot=hot, lead=lead)
    assert out.columns == [*df.columns, "_removed"]
    got = {r.line: (r._removed, r.text) for r in out.collect()}
    assert got == {k: (g, t) for k, (_, g, t) in enumerate(brute(docs))}
    assert all((r.n, r.r, r._rid, r._gone, r._among, r.f, r.x) == (1, 2, "x", "y", 3, 4, 5) for r in out.collect())
    assert lines.dedup(df.limit(0)).count() == 0


def test_a_hot_list_of_short_lines(spark):
    """One short line and very many that add a word to it."""
    rng = random.Random(2)
    docs = [(k, "is on at by to " + f"w{rng.randrange(400)}") for k in range(90)] + [(200, "is on at by to"), (7, "is on at by"), (8, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((r.doc_id, r._removed) for r in lines.dedup(df, hot=4, lead=2).collect())
    assert got == sorted((d, g) for (d, _), (_, g, _) in zip(docs, brute(docs))) and sum(g for _, g in got) > 3


def test_a_text_of_megabytes(spark):
    rng = random.Random(3)
    line = lambda: " ".join(f"v{rng.randrange(30000)}" for _ in range(30))
    long = [line() for _ in range(50_000)]
    near = long[777].rsplit(" ", 1)[0] + " other"
    docs = [(1, "\n".join(long)), (2, near + "\nquite new words here"), (3, "x" * 3_000_000 + "\n" + long[5].upper())]
    got = {r.doc_id: (r._removed, r.text) for r in lines.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: (0, docs[0][1]), 2: (1, "quite new words here"), 3: (1, "x" * 3_000_000)}


def test_lists_are_told_from_what_was_asked_where_they_are_made(spark):
    """Of the index, only rows that may meet an asked one leave their task, and all of these do."""
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.zipf(1.4, rng.integers(5, 60)) % 500).astype(np.uint32) * np.uint32(8_000_009) for _ in range(300)]
    schema = "cid long, id long, line int, r long, n int, h binary"
    classes = spark.createDataFrame([(i, i, 0, i, len(x), x.tobytes()) for i, x in enumerate(sets)], schema)
    slots = lambda b: (np.frombuffer(b"".join(b.column("h").to_pylist()), np.uint32) >> (32 - lines.SLOT_BITS)).astype(np.int64)
    counts = spark.sparkContext.broadcast(lines.slot_counts(classes.select("h"), lines.SLOT_BITS, slots))
    every = {tuple(r) for r in lines._index(classes, 80, counts).collect()}
    asked = [(r[0], r[5]) for r in sorted(every)[::97]]
    bits = spark.sparkContext.broadcast(lines._asked_bits(spark.createDataFrame(asked, "key long, n int"), 80))
    some = {tuple(r) for r in lines._index(classes, 80, counts, bits).collect()}
    near = {r for r in every if any(r[0] == k and 80 * max(r[5], n) <= 100 * min(r[5], n) for k, n in asked)}
    assert near and near <= some <= every and len(some) < len(every) / 2
