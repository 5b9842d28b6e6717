import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from tessera.llm import packing, simple8b, token_ids

ROWS = [
    (5, "a  b\n\n c. it's  the", "x"),
    (5, "a  b\n\n c. it's  the", "x"),
    (None, "no id", None),
    (7, None, None),
    (9, "", "x"),
    (1, "word, " * 1500, "y"),
    (2, "é́ ñ <|endoftext|> end ", "y"),
    (3, " lead\ttab  ", "y"),
    (-4, "Ti wh, enndst.\nOnble 12 345!", "y"),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "doc_id long, text string, start string")


def ids_of(name, end):
    tok = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda text: [*tok.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_simple8b_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 59, 60, 61, 1023, 1024, 1025, 9000):
        for top in (1, 2, 300, 50_000, 1 << 40):
            x = rng.integers(0, top, n).astype(np.uint64)
            w, b, e = simple8b.encode(x)
            assert simple8b.decode(w, b, e, n).tolist() == x.tolist()
    x = np.array([0] * 500 + [2**64 - 1, 2**60, 2**60 - 1, 5] * 300, np.uint64)
    w, b, e = simple8b.encode(x)
    assert len(e) == 600 and simple8b.decode(w, b, e, len(x)).tolist() == x.tolist()
    assert len(simple8b.encode(np.zeros(1024, np.uint64))[0]) == 18


def test_simple8b_files(spark, tmp_path):
    scratch = simple8b.Scratch(spark, "t")
    rows = scratch.save(simple8b.write(frame(spark), str(tmp_path / "s"), public_tokenizers.path("word_bpe_49k.json"), 1))
    got = [tuple(r) for r in simple8b.read(spark, rows, str(tmp_path / "s")).collect()]
    of, at, want = ids_of("word_bpe_49k.json", 1), 0, []
    for d, t, _ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = of(t)
        want.append((d, at, len(ids), crc(ids)))
        at += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want
    assert simple8b.write(frame(spark, []), str(tmp_path / "e"), public_tokenizers.path("word_bpe_49k.json"), 1).count() == 0


def test_queries_match_the_library(spark):
    d = "/root/testdata/sf0.001"
    docs = sorted(pq.read_table(f"{d}/documents.parquet").to_pylist(), key=lambda r: r["doc_id"])
    of, at = ids_of("word_bpe_49k.json", 1), 0
    got = {r.doc_id: r for r in simple8b.op2_simple8b(spark, d).collect()}
    for r in docs:
        ids = of(r["text"])
        assert tuple(got[r["doc_id"]]) == (r["doc_id"], at, len(ids), crc(ids))
        at += len(ids)
    check_packed(packing.op3_best_fit(spark, d).collect(), [(r["doc_id"], r["text"]) for r in docs])


def check_packed(rows, docs):
    of, pieces, places = ids_of("byte_bpe_50k.json", 2), {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    want = {}
    for d, t in docs:
        ids = of(t)
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids), 1024), len(ids)]
        want.setdefault(d, []).extend((k, a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert {d: sorted((r.piece, r.start, r.length, r.ids_crc32) for r in x) for d, x in pieces.items()} == {d: sorted(x) for d, x in want.items()}
    total = 0
    for x in places.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= 1024
        total += at
    lengths = sorted((r.length for r in rows), reverse=True)
    room = []
    for n in lengths:  # best-fit decreasing, piece by piece
        fit = min((x for x in room if x >= n), default=None)
        if fit is not None:
            room.remove(fit)
        room.append((1024 if fit is None else fit) - n)
    assert len(places) == len(room)


def test_packing_odd_rows(spark):
    check_packed(packing.pack(frame(spark), public_tokenizers.path("byte_bpe_50k.json")).collect(), [r[:2] for r in ROWS])
    assert packing.pack(frame(spark, []), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_best_fit_counts():
    rng = np.random.default_rng(2)
    for size in (10, 64):
        counts = {int(k): int(v) for k, v in zip(range(1, size + 1), rng.integers(0, 50, size))}
        slots, made = packing.best_fit(counts, size)
        fill, ranks = np.zeros(made, int), {k: 0 for k in counts}
        for length, rank, n, first, per, _ in sorted(slots):
            assert rank == ranks[length]
            ranks[length] += n
            for i in range(n):
                fill[first + i // per] += length
        assert ranks == counts and fill.max() <= size
        assert made - sum(k * v for k, v in counts.items()) / size < 0.1 * made + 1


@pytest.mark.parametrize(("name", "blank"), [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_ids_equal_the_library(name, blank):
    """Every code point of the first three planes alone, within letters and before punctuation, and random mixes."""
    code = token_ids.Coder(public_tokenizers.path(name), blank)

    def same(texts):
        ids, n = code.encode(texts)
        want = [e.ids for e in code.tok.encode_batch(texts, add_special_tokens=False)]
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == want

    points = [chr(i) for i in range(0x32400) if not 0xD800 <= i < 0xE000]
    for i in range(0, len(points), 64):
        part = points[i : i + 64]
        same(["ab " + " ".join(part), "".join(f"a{x}b {x}{x}. " for x in part)])
    rng = random.Random(1)
    some = points[:0x600] + [" ", "\n", "\t", "́", "İ", "क़", "ſ", "K", "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "'LL", "\x1c", "\x85", "\xa0", " ", "　", "  "] * 40 + list("abcdefABC") * 60
    same(["".join(rng.choice(some) for _ in range(rng.randrange(60))) for _ in range(5000)])


def test_pieces_met_often_stay_and_the_cache_is_bounded():
    rng = random.Random(21)
    often = [f"of{chr(97 + k)}" for k in range(20)]
    for name, blank in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        code = token_ids.Coder(public_tokenizers.path(name), blank)
        code.MOST, held, learned = 100, [], []
        encoded = code._encoded
        code._encoded = lambda pieces, f=encoded, to=learned: to.extend(pieces) or f(pieces)
        for k in range(30):
            texts = [" ".join(rng.choice(often) if j % 3 else f"é{chr(97 + rng.randrange(26))}È{rng.choice('.,x')}{rng.randrange(9**6)}" for j in range(60)) for _ in range(2)] + ["İstanbul ſtraße ﬁx", "été ÉTÉ"]
            ids, lengths = code.encode(texts)
            want = [e.ids for e in code.tok.encode_batch(texts, add_special_tokens=False)]
            assert ids.tolist() == [i for x in want for i in x] and lengths.tolist() == list(map(len, want))
            held.append(len(code.at))
        assert max(held) < 100 + 3 * 60 and all(sum(p == w for p in learned) <= 2 for w in often)


def test_packing_does_not_depend_on_the_pieces_held(spark):
    docs = spark.createDataFrame([(k, " ".join(f"w{k * j % 97} é{j}" for j in range(k * 20))) for k in range(60)], "doc_id long, text string").repartition(2)
    path = public_tokenizers.path("byte_bpe_50k.json")
    few, many = (sorted(map(tuple, packing.cut(docs, path, 2, 1024, held).select("doc_id", "piece", "start", "length", "ids_crc32").collect())) for held in (20, packing.HELD))
    assert few == many
