"""Operator 5: toxicity by compression distance.

Two zstandard dictionaries are trained, on toxic and on ordinary text. A window of a document is compressed with the
ordinary one and with both; where the toxic dictionary shortens it by GAIN bytes or more, the window speaks for toxicity.
The share of such windows, the mean and the largest gain go through a logistic calibration fitted on labelled rows that
trained no dictionary, so a score of 0.5 is the calibrated threshold.

The toxic dictionary is trained on the passages of toxic texts whose byte 4-grams are far more frequent in toxic than in
ordinary documents: what both kinds share says nothing and would fill it.

Learning reads a bounded sample of labelled rows: at most ROWS of each class in hash order and at most BYTES of text of
each, whole texts only. Scoring reads every whole text.

Cases: a null or empty text scores as a text without a telling window; with only one class among the labelled rows (or
none) every score is that class's smoothed share; labels that disagree for a doc_id count as toxic; a null doc_id is
scored and never learned from; repeated rows score alike; extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import documents, texts, tidied, unused

#: Bounds of the labelled sample, for each class.
ROWS, BYTES = {1: 1500, 0: 3000}, 12_000_000
WINDOW, STEP, LEVEL, GAIN, GRAM = 64, 48, 12, 3, 4
BASE, TOXIC = 28_000, 2_048
#: The score's column until a caller names it: a table of documents may have a column of that name.
SCORE = "_toxicity_score"
_SCORERS: dict[bytes, Scorer] = {}


def windows(text: bytes) -> list[bytes]:
    return [text[i : i + WINDOW] for i in range(0, max(1, len(text) - WINDOW + STEP), STEP)]


def _trained(size: int, samples: list[bytes], k: int) -> bytes:
    try:
        return zstandard.train_dictionary(size, samples, k=k, d=6).as_bytes()
    except zstandard.ZstdError:  # too few samples to train: their end is the dictionary
        return b"".join(samples)[-size:]


def telling(toxic: list[bytes], ordinary: list[bytes], odds: float = 8, least: int = 8) -> list[bytes]:
    """Passages of toxic texts, with a byte around them, whose 4-grams are ``odds`` times as frequent there."""
    grams = lambda b: {b[i : i + GRAM] for i in range(len(b) - GRAM + 1)}
    t, o = Counter(g for b in toxic for g in grams(b)), Counter(g for b in ordinary for g in grams(b))
    rate = lambda c, g, n: (c[g] + 0.5) / (n + 1)
    least = max(2, min(least, len(toxic) // 20))
    marks = {g for g in t if t[g] >= least and rate(t, g, len(toxic)) > odds * rate(o, g, len(ordinary))}
    out = []
    for b in toxic:
        run = None
        for i in (i for i in range(len(b) - GRAM + 1) if b[i : i + GRAM] in marks):
            if run and i <= run[1] + 2:
                run[1] = i + GRAM
            else:
                if run:
                    out.append(b[max(0, run[0] - 1) : run[1] + 1])
                run = [i, i + GRAM]
        if run:
            out.append(b[max(0, run[0] - 1) : run[1] + 1])
    return out


class Scorer:
    """Features of a text under two dictionaries."""

    def __init__(self, toxic: bytes, base: bytes):
        self.size = [self._sizes(toxic + base), self._sizes(base)]

    @staticmethod
    def _sizes(raw: bytes):
        d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        c = zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
        return lambda w: len(c.compress(w))

    def features(self, text: bytes) -> tuple[float, float, float]:
        with_toxic, without = self.size
        g = [without(w) - with_toxic(w) for w in windows(text.lower())]
        return sum(x >= GAIN for x in g) / len(g), sum(g) / len(g), float(max(g))


def _design(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, float).reshape(-1, 3)
    return np.column_stack([np.ones(len(x)), np.sqrt(x[:, 0]), x[:, 1], x[:, 2] / 4, x[:, 0] > 0])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 50) -> np.ndarray:
    a, w = _design(x), np.zeros(5)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(5), a.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(rows: list[tuple[bytes, int]]) -> dict:
    """A model from labelled (text, toxic) rows: two thirds train the dictionaries, the others calibrate."""
    n, toxic = len(rows), sum(y for _, y in rows)
    prior = (toxic + 0.5) / (n + 1)
    if not 0 < toxic < n:
        return {"toxic": b"", "base": b"", "w": [math.log(prior / (1 - prior)), 0, 0, 0, 0]}
    own = {y: [t.lower() for t, k in rows if k == y] for y in (0, 1)}
    train = {y: [t for i, t in enumerate(x) if i % 3] or x for y, x in own.items()}
    held = [(t, y) for y, x in own.items() for t in (x[::3] if len(x) > 2 else x)]
    cut = [t[i : i + 256] for t in train[0] for i in range(0, len(t), 256)]
    base = _trained(32_768, cut[:: max(1, len(cut) // 20_000)], 64)[-BASE:]
    marks = telling(train[1], train[0])
    dictionary = _trained(TOXIC, [b" ".join(marks[i : i + 8]) for i in range(0, len(marks), 8)], 24) if marks else b""
    score = Scorer(dictionary, base)
    w = _logistic(np.array([score.features(t) for t, _ in held]), np.array([y for _, y in held], float))
    return {"toxic": dictionary, "base": base, "w": w.tolist()}


def sample(docs: DataFrame, labels: DataFrame) -> list[tuple[bytes, int]]:
    """The bounded labelled sample: ids first, then sizes, then the texts of the ids that stay."""
    known = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic is not null and doc_id is not null")
    known = known.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0).withColumn("h", F.xxhash64("doc_id"))
    texts_ = docs.select(F.col("doc_id").alias("id"), "text")
    out = []
    for y, most in ROWS.items():
        ids = known.where(F.col("toxic") == y).orderBy("h", "doc_id").limit(most)
        sized = ids.join(texts_.select("id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n")), F.col("doc_id") == F.col("id"))
        sized = sized.orderBy("h", "doc_id").limit(most)
        upto = sized.withColumn("upto", F.sum("n").over(Window.orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, 0)))
        keep = upto.where((F.col("upto") <= BYTES) | (F.col("upto") == F.col("n"))).select("doc_id", "h").distinct()
        got = keep.join(texts_, F.col("doc_id") == F.col("id")).select("h", "doc_id", "text").collect()
        out += [((r["text"] or "").encode(), y) for r in sorted(got, key=lambda r: (r["h"], r["doc_id"], r["text"] or ""))]
    return out


def score(docs: DataFrame, model: dict, keep: list[str] | None = None, name: str = SCORE) -> DataFrame:
    """Every row's columns ``keep`` and its score, in a column ``name`` that must not be one of them."""
    keep = keep or ["doc_id"]
    fields = [f for f in docs.schema.fields if f.name in keep]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of fixed size

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        key = m["toxic"] + b"\0" + m["base"]
        if m["base"] and key not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[key] = Scorer(m["toxic"], m["base"])
        for batch in batches:
            x = [_SCORERS[key].features(t) if m["base"] else (0.0, 0.0, 0.0) for t in texts(batch)]
            p = 1 / (1 + np.exp(-np.clip(_design(np.array(x)) @ np.array(m["w"]), -30, 30)))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in fields), pa.array(p)], [*(f.name for f in fields), name])

    from pyspark.sql.types import DoubleType, StructField, StructType

    names = [f.name for f in fields]
    return docs.select(*dict.fromkeys([*names, "text"])).mapInArrow(tidied(run), StructType([*fields, StructField(name, DoubleType())]))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents (all columns that the table of documents has) that score below the threshold."""
    columns = docs.columns
    (name,) = unused(columns, SCORE)
    return score(docs, fit(sample(docs, labels)), columns, name).where(F.col(name) < threshold).select(*columns)


def op5_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = score(docs, fit(sample(docs, labels)))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), F.col(SCORE).alias("score"), (F.col(SCORE) >= 0.5).cast("int").alias("predicted"))
