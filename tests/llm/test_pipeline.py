import math

import pytest
from test_lines import brute as brute_lines
from test_mixing_and_digests import targets
from test_near_dups import brute as brute_near

import corpus_pipeline
from tessera.llm import toxicity

SF = "/root/testdata/sf0.001"


def stages(spark, docs, folder):
    out = [docs]
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, out[-1], SF).write.parquet(f"{folder}/{k}")
        out.append(spark.read.parquet(f"{folder}/{k}"))
    return out


def check(spark, docs, folder):
    start, clean, cut, first, mixed, packed = stages(spark, docs, folder)
    assert all(x.columns == docs.columns for x in (clean, cut, first, mixed))
    rows = lambda df: [(r.doc_id, r.text, r.source) for r in df.collect()]
    key = lambda r: tuple(map(str, r))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = toxicity.score(start, toxicity.fit(toxicity.sample(start, labels)), ["doc_id", "text", "source"]).collect()
    assert sorted(rows(clean), key=key) == sorted(((r.doc_id, r.text, r.source) for r in scores if r[toxicity.SCORE] < 0.5), key=key)
    was = rows(clean)
    want = [(d, t, s) for (d, _, s), (_, _, t) in zip(was, brute_lines([r[:2] for r in was]))]
    assert sorted(rows(cut), key=key) == sorted(want, key=key)
    if "n_chars" in docs.columns:
        assert all(r.n_chars == len(r.text) for r in cut.collect() if r.text is not None)
    was = rows(cut)
    kept = {d for d, _, c in brute_near([r[:2] for r in was if r[0] is not None], 5) if d == c}
    got = rows(first)
    assert sorted(r[0] for r in got if r[0] is not None) == sorted(kept) and set(got) <= set(was)
    assert sum(r[0] is None for r in got) == sum(r[0] is None for r in was)
    sizes, taken = {}, {}
    for _, t, s in got:
        sizes[s] = sizes.get(s, 0) + len((t or "").encode().split())
    for _, t, s in rows(mixed):
        taken[s] = taken.get(s, 0) + len((t or "").encode().split())
    for s, t in targets(sizes).items():
        assert abs(taken.get(s, 0) - t) <= max([len((x or "").encode().split()) for _, x, k in got if k == s], default=0)
    assert set(rows(mixed)) <= set(got) and max((rows(mixed).count(r) for r in got[:50]), default=0) <= 3
    return rows(mixed), packed.collect()


def test_stages_match_brute_force(spark, tmp_path):
    mixed, packed = check(spark, spark.read.parquet(f"{SF}/documents.parquet"), str(tmp_path))
    from collections import Counter

    copies = Counter(d for d, _, _ in mixed)
    once = {d: t for d, t, _ in mixed if copies[d] == 1}
    assert {r.doc_id for r in packed} == set(copies)
    assert sum(r.length for r in packed) / 1024 <= len({r.sequence_id for r in packed}) <= math.ceil(sum(r.length for r in packed) / 1024 * 1.05) + 1
    assert once


def test_odd_rows(spark, tmp_path):
    rows = [(1, "a b c d e f g", "x"), (1, "a b c d e f g", "x"), (None, "a b", None), (2, None, "x"), (3, "", None), (4, "q r s\nq r s\nt", "é")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).write.parquet(str(tmp_path / "in"))
    mixed, packed = check(spark, spark.read.parquet(str(tmp_path / "in")), str(tmp_path))
    assert sum(r.piece == 0 for r in packed) == len(mixed)
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(str(tmp_path / "none"))
    empty = stages(spark, spark.read.parquet(str(tmp_path / "none")), str(tmp_path / "e"))
    assert [x.count() for x in empty] == [0] * 6


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0


@pytest.mark.parametrize("name", ["toxicity", "line dedup", "MinHash near-dedup", "mixing sources to target weights", "best-fit packing"])
def test_stage_names(name):
    assert name in dict(corpus_pipeline.STAGES)
