"""Operator 2: token ids as Simple-8b words in shard files of their own format, written and read by Spark tasks.

A 64-bit word holds a selector in its top four bits and as many equal-width values as fit in the other sixty. Greedy
choice: of the selectors whose values all fit, the one with most values. Selector 0 is an escape: its payload is the
place of one full 64-bit value in the shard's escape list. Blocks of BLOCK ids start at a new word and have their word
offset in the header, so all blocks encode and decode side by side in numpy, and any one can be read alone.

Shard file, little-endian: magic ``TS8B0001``; six u64 (docs, ids, blocks, words, escapes, block size); doc ids i64;
doc id present u8; ids of each document u64; word offset of each block and the end u64; escapes u64; words u64.

Cases: a null or empty text has only its end id; a null doc_id is kept and sorts first; rows that share a doc_id are
ordered by their text's hash and kept; an empty table gives no shard and no rows; further columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, documents, offsets
from tessera.llm.token_ids import coder, with_end

BLOCK = 1024
MAGIC = b"TS8B0001"
#: Fixed values of the coding: values in a word and bits of each, by selector from 1 on.
PACKINGS = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
_COUNTS = np.array([1] + [n for n, _ in PACKINGS], np.int64)
#: Ids in a shard at most, give or take one batch: bounds a writer's memory.
SHARD_IDS = 2_000_000


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, word offset of each block and the end, escapes) for unsigned ids."""
    ids = np.asarray(ids, np.uint64)
    n = len(ids)
    blocks = -(-n // BLOCK)
    starts = np.arange(blocks, dtype=np.int64) * BLOCK
    ends = np.minimum(starts + BLOCK, n)
    bits = np.zeros(n + 60, np.uint8)
    small = ids < (1 << 60)
    bits[:n] = np.where(small, np.frexp(ids.astype(np.float64))[1], 64)
    near = small & (bits[:n] > 50)  # where a float may round up to the next power of two
    if near.any():
        bits[:n][near] = [int(x).bit_length() for x in ids[near]]
    at, alive, where, chosen, block = starts.copy(), np.arange(blocks), [], [], []
    while len(alive):
        pos = at[alive]
        pick = np.zeros(len(pos), np.int64)
        for width, first, last in ((8, 7, 14), (60, 1, 6)):  # the narrow look decides but for small values
            look = np.arange(len(pos)) if width == 8 else np.flatnonzero(pick == 7)
            if not len(look):
                continue
            reach = pos[look][:, None] + np.arange(width)
            seen = np.where(reach < ends[alive[look]][:, None], bits[np.minimum(reach, n)], 0)
            top = np.maximum.accumulate(seen, axis=1)
            for s in range(last, first - 1, -1):
                count, wide = PACKINGS[s - 1]
                pick[look[top[:, count - 1] <= wide]] = s
        where.append(pos)
        chosen.append(pick)
        block.append(alive)
        at[alive] = pos + _COUNTS[pick]
        alive = alive[at[alive] < ends[alive]]
    if not where:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint64), np.zeros(0, np.uint64)
    pos, pick, own = np.concatenate(where), np.concatenate(chosen), np.concatenate(block)
    order = np.argsort(pos, kind="stable")
    pos, pick, own = pos[order], pick[order], own[order]
    padded = np.concatenate([ids, np.zeros(60, np.uint64)])
    words = pick.astype(np.uint64) << np.uint64(60)
    escaped = pick == 0
    escapes = ids[pos[escaped]]
    words[escaped] |= np.arange(len(escapes), dtype=np.uint64)
    for s, (count, wide) in enumerate(PACKINGS, 1):
        mine = np.flatnonzero(pick == s)
        if len(mine):
            end = ends[own[mine]]
            for j in range(count):
                inside = pos[mine] + j < end
                words[mine[inside]] |= padded[pos[mine[inside]] + j] << np.uint64(j * wide)
    return words, np.searchsorted(own, np.arange(blocks + 1)).astype(np.uint64), escapes


def decode(words: np.ndarray, blocks: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The n ids; inverse of encode. All words of a selector are unpacked at once."""
    pick = (words >> np.uint64(60)).astype(np.int64)
    upto = offsets(_COUNTS[pick])
    first = upto[blocks.astype(np.int64)]
    out = np.zeros(int(upto[-1]), np.uint64)
    load = words & np.uint64((1 << 60) - 1)
    out[upto[:-1][pick == 0]] = escapes[load[pick == 0].astype(np.int64)]
    for s, (count, wide) in enumerate(PACKINGS, 1):
        mine = np.flatnonzero(pick == s)
        for j in range(count if len(mine) else 0):
            out[upto[mine] + j] = (load[mine] >> np.uint64(j * wide)) & np.uint64((1 << wide) - 1)
    if not n:
        return out[:0]
    room = np.diff(first)
    place = np.arange(len(out)) - np.repeat(first[:-1], room)  # a block's last word may have room to spare
    size = np.full(len(room), BLOCK, np.int64)
    size[-1] = n - BLOCK * (len(room) - 1)
    return out[place < np.repeat(size, room)]


def pack_shard(doc_ids: list, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    words, blocks, escapes = encode(ids)
    head = np.array([len(doc_ids), len(ids), max(0, len(blocks) - 1), len(words), len(escapes), BLOCK], "<u8")
    docs = np.array([d or 0 for d in doc_ids], "<i8")
    known = np.array([d is not None for d in doc_ids], np.uint8)
    return b"".join([MAGIC, *(x.tobytes() for x in (head, docs, known, lengths.astype("<u8"), blocks.astype("<u8"), escapes.astype("<u8"), words.astype("<u8")))])


def unpack_shard(raw: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(doc ids, lengths, ids) of a shard file."""
    if raw[:8] != MAGIC:
        raise ValueError("not a Simple-8b shard")
    docs, n, blocks, words, escapes, size = np.frombuffer(raw, "<u8", 6, 8).astype(int)
    if size != BLOCK:
        raise ValueError(f"block size {size}, expected {BLOCK}")
    at, parts = 56, []
    for kind, count in (("<i8", docs), ("u1", docs), ("<u8", docs), ("<u8", blocks + 1), ("<u8", escapes), ("<u8", words)):
        parts.append(np.frombuffer(raw, kind, count, at))
        at += parts[-1].nbytes
    ids, known, lengths, offs, esc, w = parts
    return [int(i) if k else None for i, k in zip(ids, known, strict=True)], lengths.astype(np.int64), decode(w.astype(np.uint64), offs, esc.astype(np.uint64), int(n))


def write(docs: DataFrame, to: str, tokenizer: str, end_id: int) -> DataFrame:
    """Encodes (doc_id, text) in ascending doc_id order into shard files below ``to``; one row (part, seq, file, n_ids)
    for each shard. A file has a name of its own for each attempt, so only the files in these rows count."""

    def shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        uri = to.replace("s3a://", "s3://", 1)  # Hadoop's name for what pyarrow calls s3
        where, base = fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)
        part, seq, held, rows = TaskContext.get().partitionId(), 0, [], []
        code = coder(tokenizer, False)

        def flush() -> None:
            nonlocal seq, held
            ids, lengths = np.concatenate([x for _, x, _ in held]), np.concatenate([x for _, _, x in held])
            name = f"{part:07d}-{seq:05d}-{uuid.uuid4().hex}.s8b"
            where.create_dir(base, recursive=True)
            with where.open_output_stream(f"{base}/{name}") as f:
                f.write(pack_shard([d for x, _, _ in held for d in x], lengths, ids))
            rows.append((part, seq, name, len(ids)))
            seq, held = seq + 1, []

        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                some = batch.slice(i, 1024)
                ids, lengths = with_end(*code.encode(some.column("text").to_pylist()), end_id)
                held.append((some.column("doc_id").to_pylist(), ids, lengths))
                if sum(len(x) for _, x, _ in held) >= SHARD_IDS:
                    flush()
        if held:
            flush()
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(("part", "seq", "file", "n_ids"), r, strict=True)) for r in rows], pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("n_ids", pa.int64())]))

    key = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    ordered = docs.select("doc_id", "text").repartitionByRange(*key).sortWithinPartitions(*key)
    return ordered.mapInArrow(shards, "part int, seq int, file string, n_ids long")


def read(spark: SparkSession, shards: DataFrame, where: str) -> DataFrame:
    """Per document of the shard files: doc_id, start, n_tokens, ids_crc32. The files are read by Spark's binaryFile."""
    upto = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    known = shards.select("file", F.coalesce(F.sum("n_ids").over(upto), F.lit(0)).alias("base"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.s8b").load(where)
    found = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content").join(known, "file").select("base", "content")

    def documents_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, raw in zip(batch.column("base").to_pylist(), batch.column("content"), strict=True):
                docs, lengths, ids = unpack_shard(raw.as_py())
                at, ids = offsets(lengths), ids.astype("<u4")
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(at[:-1] + base), pa.array(lengths), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return found.mapInArrow(documents_of, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op2_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    scratch = Scratch(spark, "op2")
    to = scratch.path("shards")
    rows = scratch.save(write(documents(spark, sf_dir), to, public_tokenizers.path("word_bpe_49k.json"), 1), "rows")
    if rows.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read(spark, rows, to)
