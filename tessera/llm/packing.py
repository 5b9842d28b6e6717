"""Operator 3: best-fit packing planned on the histogram of lengths.

Documents longer than a sequence are cut into full pieces (the first may be shorter). The plan needs only how many
pieces have each length, at most 1024 numbers: best-fit decreasing puts whole runs of equal pieces into runs of equal
sequences. Pieces then take the planned slots by their rank within their length: shards count their own pieces, the
counts' running sums give each shard its first rank, and no task sees all pieces of a length.

Cases: a null or empty text has only its end id; rows that share a doc_id are separate documents, a null doc_id too;
an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, documents, offsets, ragged, tidied
from tessera.llm.token_ids import coder, with_end

#: Distinct pieces of text that a worker keeps the ids of: about 180 MB for a million, no result depends on it.
HELD = 1_200_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, shard int, local long"


def cut(docs: DataFrame, tokenizer: str, end_id: int, size: int, held: int = HELD) -> DataFrame:
    """The pieces of each document, numbered within (shard, length); a shard is a task's partition."""

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, shard, seen = coder(tokenizer, True, held), TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for whole in batches:
            for i in range(0, whole.num_rows, 1024):
                batch = whole.slice(i, 1024)
                ids, total = with_end(*code.encode(batch.column("text").to_pylist()), end_id)
                count = -(-total // size)
                doc = np.repeat(np.arange(len(total)), count)
                piece = ragged(np.zeros(len(total), np.int64), count)
                first = total - (count - 1) * size
                start = np.where(piece == 0, 0, first[doc] + (piece - 1) * size)
                length = np.where(piece == 0, first[doc], size)
                at = offsets(total)[doc] + start
                raw = ids.astype("<u4")
                crc = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(at, at + length, strict=True)]
                order = np.argsort(length, kind="stable")
                within = np.arange(len(length)) - np.searchsorted(length[order], length[order])
                local = np.empty(len(length), np.int64)
                local[order] = within + seen[length[order]]
                seen += np.bincount(length, minlength=size + 1)
                columns = [batch.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(np.full(len(doc), shard), pa.int32()), pa.array(local)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "shard", "local"])

    return docs.select("doc_id", "text").mapInArrow(tidied(pieces), PIECES)


def best_fit(counts: dict[int, int], size: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """(slots, sequences) for counts[length] pieces. A slot run (length, rank, pieces, first sequence, per sequence,
    offset) gives pieces of ranks rank.. their places: ``per sequence`` at a time, from ``offset`` on, in consecutive
    sequences. The number of runs depends on ``size`` alone, never on the number of pieces."""
    open_: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]  # by room left: runs of sequences (first, how many)
    slots, made = [], 0
    for length in sorted((x for x, n in counts.items() if n), reverse=True):
        left, rank = counts[length], 0
        room = length
        while left and room <= size:  # the fullest sequences that it fits
            if not open_[room]:
                room += 1
                continue
            first, many = open_[room].pop()
            fit = min(room // length, left)
            used = min(many, max(1, left // fit))
            slots.append((length, rank, used * fit, first, fit, size - room))
            open_[room - fit * length].append((first, used))
            if used < many:
                open_[room].append((first + used, many - used))
            rank, left = rank + used * fit, left - used * fit
            room = length  # sequences that were just filled may have room again
        per = size // length
        for fit, used in ((per, left // per), (left % per, 1 if left % per else 0)):
            if fit and used:
                slots.append((length, rank, used * fit, made, fit, 0))
                open_[size - fit * length].append((made, used))
                made, rank = made + used, rank + used * fit
    return slots, made


def place(pieces: DataFrame, slots: list[tuple]) -> DataFrame:
    """Joins pieces to slots by rank within length; ``pieces`` must be a written table."""
    spark = pieces.sparkSession
    held = pieces.groupBy("shard", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    first = held.select(F.col("shard").alias("s"), F.col("length").alias("len"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = pieces.join(first, (F.col("shard") == F.col("s")) & (F.col("length") == F.col("len")))
    plan = pd.DataFrame(slots, columns=["length", "rank", "n", "sequence", "per", "offset"]).sort_values(["length", "rank"])
    arrays = spark.sparkContext.broadcast({c: plan[c].to_numpy(np.int64) for c in plan})  # bounded by the sequence size

    def placed(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = arrays.value
        wide = np.int64(1) << np.int64(44)
        for f in frames:
            rank, length = (f["local"] + f["first"]).to_numpy(np.int64), f["length"].to_numpy(np.int64)
            k = np.searchsorted(p["length"] * wide + p["rank"], length * wide + rank, side="right") - 1
            into = rank - p["rank"][k]
            yield f[["doc_id", "piece", "start", "length", "ids_crc32"]].assign(sequence_id=p["sequence"][k] + into // p["per"][k], offset=p["offset"][k] + into % p["per"][k] * length)

    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "local", "first")
    return ranked.mapInArrow(_frames(placed), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def _frames(f):
    """A function on pandas frames as one on Arrow batches, which keeps null ids."""

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for out in f([batch.drop_columns(["doc_id"]).to_pandas().assign(doc_id=0)]):
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(out[c]) for c in out.columns[1:])], list(out.columns))

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, size: int = 1024, held: int = HELD) -> DataFrame:
    """Every piece of every document with its sequence and place. A smaller ``held`` takes less memory and more time."""
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = scratch.save(cut(docs, tokenizer, end_id, size, held), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # a row for each length
    slots, _ = best_fit(counts, size)
    if not slots:
        return docs.sparkSession.createDataFrame([], "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return place(pieces, slots)


def op3_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
