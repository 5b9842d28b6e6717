import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F

from tessera.llm import byte_bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


def library(path=PATH):
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def same(code, lib, texts):
    raw = [x.encode() for x in texts]
    ids, n = code.encode(raw)
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [lib.encode_ordinary(x) for x in texts]
    assert code.decode(ids, n) == raw
    at = code.starts(ids, n)
    for text, a, own in zip(raw, np.split(at, np.cumsum(n)[:-1]), np.split(ids, np.cumsum(n)[:-1])):
        assert all(text[i:].startswith(lib.decode_single_token_bytes(int(k))) for i, k in zip(a[:200], own[:200]))


@pytest.mark.parametrize("name", ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def test_ids_equal_the_library(name):
    code, lib = byte_bpe.Coder(P.path(name)), library(P.path(name))
    same(code, lib, ["", "a", " ", "  ", "\n", " \n a", "a  b", "it's 'll 're'vex 's''s a's's 'LL 'l 'r", "'", "''s", " 's", "\n's", "1's", "'sabc", "'", "x'", "", "'re"])
    rng = random.Random(1)
    some = list(" \n\t'strvemlldaZ1९.,!éñЖ字　\x1c\x85\xa0 😀ﬁǅ̀\x00")
    for _ in range(40):
        same(code, lib, ["".join(rng.choice(some) for _ in range(rng.randrange(60))) for _ in range(100)])
    same(code, lib, ["a" * 3000 + " " + "ab" * 3000, "\n" * 5000, "é" * 4000, "x" * 65, "'" * 70, ("ab" * 40 + " ") * 3])
    rest = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    for i in range(0, len(rest), 1 << 15):  # every code point within a word and after a blank
        part = rest[i : i + (1 << 15)]
        same(code, lib, ["ab" + "a".join(part) + " " + " ".join(part)])


def test_rows_of_a_scan_do_not_matter():
    """The states by composed functions equal those of one walk over the symbols."""
    rng = np.random.default_rng(3)
    points = np.array([ord(x) for x in " \n'sterlaé1."], np.uint32)[rng.integers(0, 12, 50_000)]
    points[rng.integers(0, 50_000, 500)] = points[-1] = ord(byte_bpe.BETWEEN)
    state, want = byte_bpe.FRESH, []
    for k, x in enumerate(byte_bpe._symbols(points)):
        state, begins = byte_bpe._step(state, int(x))
        if begins:
            want.append(k)
    assert byte_bpe.boundaries(points).tolist() == want


def test_a_full_cache_starts_anew():
    code, lib = byte_bpe.Coder(PATH), library()
    code.MOST = 3
    for _ in range(3):
        same(code, lib, ["one two three four five", "the thirteenth of Aprils"])
    code.HELD = 10
    same(code, lib, ["z" * 1000, "zz y"])


def test_odd_rows_and_megabytes(spark):
    lib, big = library(), "Lorem ipsum, dolor's 12 sit\n" * 80_000
    rows = [(1, "a  b", "k"), (1, "a  b", "k"), (None, "x", None), (2, None, "q"), (3, "", "r"), (4, big, "s"), (5, "q" * 300_000, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = byte_bpe.encode(docs, PATH)
    assert out.columns == ["doc_id", "ids", "_ids", "starts"]
    got = sorted((r.doc_id or 0, r.ids or "", r._ids, r.starts[-1:]) for r in out.collect())
    assert [(a, b, c) for a, b, c, _ in got] == sorted((a or 0, c or "", lib.encode_ordinary(b or "")) for a, b, c in rows)
    back = byte_bpe.decode(out.drop("starts"), PATH, "_ids", "text")
    assert sorted((r.doc_id or 0, bytes(r.text).decode()) for r in back.collect()) == sorted((a or 0, b or "") for a, b, _ in rows)
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r.text) for r in byte_bpe.decode(nothing, PATH).collect()] == [b"", b""]
    assert byte_bpe.encode(docs.where("false"), PATH).count() == 0 == byte_bpe.decode(nothing.where("false"), PATH).count()
    bad = spark.range(1).select(F.lit(1).alias("doc_id"), F.expr("cast(x'61ff62' as string)").alias("text"))
    assert byte_bpe.encode(bad, PATH).first().ids == lib.encode_ordinary("a�b")


def test_query_matches_the_library(spark):
    d, lib = "/root/testdata/sf0.001", library()
    want = {}
    for r in pq.read_table(f"{d}/documents.parquet", columns=["doc_id", "text"]).to_pylist():
        ids = lib.encode_ordinary(r["text"] or "")
        want[r["doc_id"]] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in byte_bpe.op11_byte_bpe(spark, d).collect()}
    assert got == want
