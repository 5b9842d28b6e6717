import hashlib
import re
import unicodedata

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

from tessera.llm import digests, mixing
from tessera.llm.common import Scratch

ROWS = [
    (5, "The  CAT\tsat", "b", 1.0),
    (5, "The  CAT\tsat", "b", 1.0),
    (None, "no id here", None, 2.0),
    (7, None, "a", None),
    (9, "", "a", 0.0),
    (1, "word, " * 1500, "é", 0.0),
    (2, "the cat SAT ", "b", 0.0),
    (3, "ﬁne ＡＢＣ straße", "a", 0.0),
    (4, "fine abc STRASSE", "a", 0.0),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size double")


def targets(sizes):
    """Water filling as the words of the contract say it."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * w[s] / sum(w[r] for r in rest) for s in rest}
        over = [s for s in rest if share[s] > 3 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 3 * sizes[s] for s in over}


def check_mix(rows, docs):
    size = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    sizes = {}
    for _, t, s in docs:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = targets(sizes)
    assert sorted((r.doc_id or -1, r.size) for r in rows) == sorted((d or -1, size(t)) for d, t, _ in docs)
    for s in sizes:
        mine = [r for r in rows if r.source == s]
        assert all(r.source_size == sizes[s] and r.target == pytest.approx(want[s]) for r in mine)
        assert all(0 <= r.copies <= 3 and r.copies == int(r.copies) for r in mine)
        assert abs(sum(r.copies * r.size for r in mine) - want[s]) <= max(r.size for r in mine)
        # rates solve the dual: the target is met, and log rate is proportional to size where it is not capped
        assert sum(r.rate * r.size for r in mine) == pytest.approx(want[s], rel=1e-6)
        tilt = [np.log(r.rate) / r.size for r in mine if r.size and 1e-12 < r.rate < 3]
        assert np.ptp(tilt) < 1e-6 if tilt else True


def test_mix(spark):
    rows = mixing.mix(frame(spark)).collect()
    check_mix(rows, [r[:3] for r in ROWS])
    assert mixing.mix(frame(spark, [])).count() == 0
    d = "/root/testdata/sf0.001"
    docs = pq.read_table(f"{d}/documents.parquet").to_pylist()
    got = mixing.mix(spark.read.parquet(f"{d}/documents.parquet")).collect()
    check_mix(got, [(r["doc_id"], r["text"], r["source"]) for r in docs])
    again = mixing.op4_entropy_mix(spark, d).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.size * r.copies) for r in got)


def canon(t):
    t = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", t).casefold())
    return re.sub(r"\s+", " ", t).strip(" ")


def fingerprint(t):
    b = canon(t).encode()
    seeds = [xxhash.xxh64(np.array([s], "<i4").tobytes(), seed=42).intdigest() for s in (1, 2)]
    return "".join(f"{xxhash.xxh64(b, seed=s).intdigest():016x}" for s in seeds)


def check_digests(rows, docs):
    docs = sorted(((d, t or "") for d, t in docs), key=lambda r: (r[0] is not None, r[0] or 0, np.int64(np.uint64(xxhash.xxh64(r[1].encode(), seed=42).intdigest()))))
    want = []
    for i, (d, t) in enumerate(docs):
        n, after = len(t), docs[(i + 1) % len(docs)][1]
        edited = t[: n - n // 2] + after[: n // 2]
        want.append((d, n, hashlib.sha256(edited.encode()).hexdigest(), fingerprint(t), fingerprint(edited), float(canon(t) == canon(edited)), float(canon(t) == canon(after))))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)


def test_digests(spark):
    check_digests(digests.fingerprints(frame(spark), Scratch(spark, "t")).collect(), [r[:2] for r in ROWS])
    check_digests(digests.fingerprints(frame(spark, ROWS[:1]), Scratch(spark, "t")).collect(), [ROWS[0][:2]])
    assert digests.fingerprints(frame(spark, []), Scratch(spark, "t")).count() == 0
    d = "/root/testdata/sf0.001"
    docs = pq.read_table(f"{d}/documents.parquet").to_pylist()
    check_digests(digests.op7_canonical_digest(spark, d).collect(), [(r["doc_id"], r["text"]) for r in docs])


def test_clashing_digests_are_told_apart(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(digests, "digest", lambda c: F.substring(c, 1, 1))
    texts = ["ab", "AB", "ac", "b", "aa"]
    rows = sorted(digests.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), Scratch(spark, "t")).collect())
    edited = [t[: len(t) - len(t) // 2] + u[: len(t) // 2] for t, u in zip(texts, texts[1:] + texts[:1])]
    marks = {(r.fingerprint, canon(t)) for r, t in zip(rows, texts)} | {(r.edited_fingerprint, canon(t)) for r, t in zip(rows, edited)}
    assert len({m for m, _ in marks}) == len({c for _, c in marks}) == len(marks) >= 4 and {m[0] for m, _ in marks} == {"a", "b"}
