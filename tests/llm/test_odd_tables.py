"""Tables of other formats, clashing names, columns without a hash, and texts of megabytes."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import lines, mixing, near_dups, packing, toxicity

LINE = "this very line stands in two texts and has more words than ten of them"


@pytest.mark.parametrize("format_", ["json", "orc", "parquet"])
def test_line_dedup_of_any_stored_table(spark, tmp_path, format_):
    rows = [(1, f"{LINE}\nfirst own line here"), (2, f"{LINE}\nsecond own line here"), (3, None)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.format(format_).save(str(tmp_path / "t"))
    docs = spark.read.schema("doc_id long, text string").format(format_).load(str(tmp_path / "t"))
    got = {r.doc_id: r.text for r in lines.dedup(docs).collect()}
    assert got[1] == rows[0][1] and LINE not in got[2] and "second own line here" in got[2]


def test_a_column_named_like_the_score(spark):
    rows = [(i, "plain words of a quiet text " * 5, 0.25) for i in range(40)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {toxicity.SCORE} double")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    out = toxicity.drop_toxic(docs, labels)
    assert out.columns == docs.columns and {r[toxicity.SCORE] for r in out.collect()} <= {0.25}


def test_rows_that_differ_in_a_map_alone(spark):
    """Of rows of one id the choice is the same whatever order they come in."""
    text = "some words that make up a text long enough for shingles of five words"
    df = spark.createDataFrame([(1, text, {"a": k}) for k in range(6)], "doc_id long, text string, extra map<string, long>")
    picks = {str(near_dups.keep_first(df.repartition(n, F.rand(n))).collect()) for n in (1, 2, 3)}
    assert len(picks) == 1 and near_dups.keep_first(df).count() == 1


BIG = ("Lorem ipsum dolor sit amet, consectetur 12 elit.\n" * 60_000) + "é" * 100_000


def test_megabytes(spark):
    """Texts of 3 MB go whole through the operators that take them one by one."""
    docs = spark.createDataFrame([(1, BIG, "x"), (2, "a b", "x"), (3, None, "y"), (4, BIG, "y")], "doc_id long, text string, source string")
    of = lambda name, end: np.array([*Tokenizer.from_file(public_tokenizers.path(name)).encode(BIG, add_special_tokens=False).ids, end], "<u4")
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).where("doc_id = 1").orderBy("piece").collect()
    ids = of("byte_bpe_50k.json", 2)
    assert sum(r.length for r in pieces) == len(ids) and all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in pieces)
    mixed = mixing.apply(docs)
    assert set(mixed.columns) == set(docs.columns) and {len(r.text) for r in mixed.where("doc_id in (1, 4)").collect()} <= {len(BIG)}
