"""Byte-level BPE by a rank file: texts to ids with the byte offset of each id, and ids back to texts.

A text is cut before any merge, as public_tokenizers.PATTERN cuts it, but without a regular expression. Every code point
has a class, every class with what follows it is a symbol, and every symbol is a function from the state before it to the
state after it. Functions compose associatively and only a few compositions exist, so they are numbered and a table holds
the number of each composition. A block of texts is laid out in rows: all rows' functions are composed at once, the
rows' totals by doubling, and then each row's states follow from the state it begins in. State and symbol together say where a piece
begins. Pieces are slices of the UTF-8 bytes; each distinct one is merged once per worker.

Null texts count as empty. Bytes that are no UTF-8 are read as U+FFFD. Repeated rows and ids stay rows of their own; a
null doc_id stays null. An empty table gives an empty result. Other columns of the input are passed by.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.llm.common import documents, offsets, ragged, texts, unused
from tessera.llm.token_ids import _grown as grown
from tessera.llm.token_ids import _Numbers as Numbers

#: Classes of code points. END stands between texts, as a lone surrogate, which no text holds.
END, BLANK, SPACE, LETTER, DIGIT, OTHER, QUOTE, ONE, TWO, EL, EE = range(11)
BETWEEN = "\udc00"
#: Symbols: a class with what follows it. White space is LAST if a non-space follows; a quote opens 0, 2 or 3 characters.
S_END, BLANK_LAST, BLANK_MORE, SPACE_LAST, SPACE_MORE, S_LETTER, S_DIGIT, S_OTHER, QUOTE_0, QUOTE_2, QUOTE_3 = range(11)
#: States: nothing open, within white space, a blank that the next piece takes, a run of one class, characters left of a suffix.
FRESH, WITHIN, TAKEN, IN_LETTERS, IN_DIGITS, IN_OTHER, LEFT_1, LEFT_2 = range(8)
#: Characters that are scanned together at most, but for a longer text, which is one block.
BLOCK = 1 << 19


@cache
def _classes() -> np.ndarray:
    """The class of every code point, by the letters, digits and white space that the tiktoken library itself knows."""
    import tiktoken

    kinds, one = np.full(0x110000, OTHER, np.uint8), {bytes([i]): i for i in range(256)}
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", DIGIT), (r"\s", SPACE)):
        found = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=one, special_tokens={})
        kinds[np.frombuffer(found.decode(found.encode_ordinary(every)).encode("utf-32-le"), np.uint32)] = kind
    kinds[ord(BETWEEN)] = END
    for letters, kind in ((" ", BLANK), ("'", QUOTE), ("stmd", ONE), ("rv", TWO), ("l", EL), ("e", EE)):
        kinds[[ord(x) for x in letters]] = kind
    return kinds


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The state after a symbol, and whether a piece begins at it."""
    if symbol == S_END:
        return FRESH, True
    if state in (LEFT_1, LEFT_2):
        return (FRESH if state == LEFT_1 else LEFT_1), False
    if symbol in (BLANK_MORE, SPACE_MORE):
        return WITHIN, state != WITHIN
    if symbol == BLANK_LAST:
        return TAKEN, True
    if symbol == SPACE_LAST:
        return FRESH, True
    if symbol in (QUOTE_2, QUOTE_3) and state not in (TAKEN, IN_OTHER):
        return (LEFT_1 if symbol == QUOTE_2 else LEFT_2), True
    run = {S_LETTER: IN_LETTERS, S_DIGIT: IN_DIGITS}.get(symbol, IN_OTHER)
    return run, state not in (TAKEN, run)


@cache
def _functions() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(state and symbol -> state, state and symbol -> begins, number of f and symbol -> number of f then the symbol's
    function, number of f and state -> state). Number 0 is the identity; all compositions that exist are numbered."""
    after = np.array([[_step(s, x)[0] for x in range(11)] for s in range(8)], np.uint8)
    begins = np.array([[_step(s, x)[1] for x in range(11)] for s in range(8)], bool)
    every, rows = [tuple(range(8))], []
    number = {every[0]: 0}
    for f in every:  # grows while it is read
        row = []
        for x in range(11):
            g = tuple(int(after[s, x]) for s in f)
            if g not in number:
                number[g] = len(every)
                every.append(g)
            row.append(number[g])
        rows.append(row)
    return after, begins, np.array(rows, np.int64), np.array(every, np.uint8)


def _symbols(points: np.ndarray) -> np.ndarray:
    """A symbol for each code point; the last one must be BETWEEN."""
    kind = _classes()[points]
    out = np.array([S_END, BLANK_MORE, SPACE_MORE, S_LETTER, S_DIGIT, S_OTHER, QUOTE_0, S_LETTER, S_LETTER, S_LETTER, S_LETTER], np.uint8)[kind]
    space = np.flatnonzero((kind == BLANK) | (kind == SPACE))
    last = space[kind[space + 1] > SPACE]
    out[last] -= 1
    quote = np.flatnonzero(kind == QUOTE)
    if len(quote):
        nxt, third = kind[quote + 1], kind[np.minimum(quote + 2, len(kind) - 1)]
        out[quote[nxt == ONE]] = QUOTE_2
        out[quote[(nxt == TWO) & (third == EE) | (nxt == EL) & (third == EL)]] = QUOTE_3
    return out


def boundaries(points: np.ndarray) -> np.ndarray:
    """Where pieces begin among code points that end with BETWEEN; each BETWEEN begins a piece of its own."""
    after, begins, then, of = _functions()
    symbols, n = _symbols(points), len(points)
    width = max(64, int(n**0.5) >> 1)
    rows = -(-n // width)
    grid = np.full(rows * width, S_END, np.uint8)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(rows, width).T)
    total = np.zeros(rows, np.int64)
    flat = then.ravel()
    for column in grid:  # functions of whole rows, all rows at once
        total = flat[total * 11 + column]
    upto, reach = of[total], 1
    while reach < rows:  # functions of all rows up to each, by doubling
        upto = np.concatenate([upto[:reach], np.take_along_axis(upto[reach:], upto[:-reach].astype(np.int64), 1)])
        reach *= 2
    state = np.concatenate([[FRESH], upto[:-1, FRESH]]).astype(np.int64)
    places, next_state = np.empty((width, rows), np.uint8), after.ravel().astype(np.int64)
    for k, column in enumerate(grid):
        places[k] = at = state * 11 + column
        state = next_state[at]
    return np.flatnonzero(begins.ravel()[places.T.ravel()[:n]])


class Coder:
    """Texts to ids by one rank file and back."""

    #: Pieces, and bytes of pieces, that are kept at most; the cache then starts anew, which bounds a worker's memory. Longer
    #: pieces than LONG bytes are merged one by one. None of these changes a result.
    MOST, HELD, LONG = 400_000, 16 << 20, 64

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.size = size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, k in ranks.items():
            tokens[k] = token
        self.length = np.fromiter(map(len, tokens), np.int64, size)
        self.begin, self.bytes = offsets(self.length)[:-1], np.frombuffer(b"".join(tokens), np.uint8)
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        self.clear()

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted numbers of all pairs of ids whose bytes together are a token, and these tokens' ids; decoding needs none."""
        ranks, size = self.ranks, self.size
        both = np.fromiter((x for t, k in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks for x in (ranks[t[:i]] * size + ranks[t[i:]], k)), np.int64)
        key, joint = both[::2], both[1::2]
        order = np.argsort(key)
        return np.append(key[order], size * size), np.append(joint[order], size)

    def clear(self) -> None:
        self.at, self.used, self.kept, self.held = Numbers(), 0, 0, 0
        self.start, self.count, self.ids = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), np.zeros(1 << 14, np.int32)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The id of two ids' bytes together, or ``size`` where there is none."""
        pairs, joint = self.pairs
        key = a * self.size + b
        at = np.searchsorted(pairs, key)
        return np.where(pairs[at] == key, joint[at], self.size)

    def merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces, and the number of each one's: in a piece the pair of the lowest id is merged first, the
        leftmost of equals. Every turn merges one pair in each piece that has one, so turns grow with the longest piece."""
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        part, own = self.single[np.frombuffer(b"".join(pieces), np.uint8)], np.repeat(np.arange(len(pieces)), length)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        pair = np.full(len(part), self.size, np.int64)
        inner = np.flatnonzero(own[1:] == own[:-1])
        pair[inner] = self.rank(part[inner], part[inner + 1])
        while len(part):
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            size = np.diff(np.concatenate([first, [len(part)]]))
            low = np.minimum.reduceat(pair, first)
            ended = low == self.size
            if ended.any():
                out = np.repeat(ended, size)
                done.append((own[out], part[out]))
                part, own, pair = part[~out], own[~out], pair[~out]
                low, size = low[~ended], size[~ended]
                if not len(part):
                    break
            hit = np.flatnonzero(pair == np.repeat(low, size))
            hit = hit[np.concatenate([[True], own[hit[1:]] != own[hit[:-1]]])]
            part[hit] = pair[hit]
            keep = np.ones(len(part), bool)
            keep[hit + 1] = False
            part, own, pair = part[keep], own[keep], pair[keep]
            hit -= np.arange(len(hit))
            for left in (hit, hit[hit > 0] - 1):
                last = left == len(part) - 1
                right = np.where(last, left, left + 1)
                pair[left] = np.where(last | (own[left] != own[right]), self.size, self.rank(part[left], part[right]))
        owners, ids = (np.concatenate([x[i] for x in done] or [np.zeros(0, np.int64)]) for i in (0, 1))
        return ids[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(pieces))

    def merged_long(self, piece: bytes) -> list[int]:
        """The same for one long piece: a heap holds the pairs and two lists the neighbours, so n bytes take n log n steps."""
        ranks, n = self.ranks, len(piece)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(pairs)
        while pairs:
            _, i, stop = heapq.heappop(pairs)
            mid = end[i]
            if not mid or mid == n or end[mid] != stop:  # one of the two has been merged since
                continue
            end[i], end[mid] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i : end[stop]])) is not None:
                    heapq.heappush(pairs, (r, i, end[stop]))
            if (p := before[i]) >= 0 and (r := ranks.get(piece[p:stop])) is not None:
                heapq.heappush(pairs, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def _learn(self) -> None:
        """Ids for the pieces that wait. A piece that is a token is that token, whatever merges would make of it."""
        new, self.at.new = self.at.new, []
        whole = [self.ranks.get(p) for p in new]
        long = {k: self.merged_long(p) for k, p in enumerate(new) if len(p) > self.LONG and whole[k] is None}
        rest = [k for k, w in enumerate(whole) if w is None and k not in long]
        count = np.ones(len(new), np.int64)
        ids, count[rest] = self.merged([new[k] for k in rest])
        for k, x in long.items():
            count[k] = len(x)
        where, last = self.used + offsets(count), self.kept + len(new)
        self.start, self.count, self.ids = grown(self.start, last), grown(self.count, last), grown(self.ids, int(where[-1]))
        self.start[self.kept : last], self.count[self.kept : last] = where[:-1], count
        alone = [k for k, w in enumerate(whole) if w is not None]
        self.ids[where[alone]] = [whole[k] for k in alone]
        self.ids[ragged(where[rest], count[rest])] = ids
        for k, x in long.items():
            self.ids[where[k] : where[k + 1]] = x
        self.kept, self.used, self.held = last, int(where[-1]), self.held + sum(map(len, new))

    def encode(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (UTF-8) in one array, and the number of each text's ids."""
        if len(self.at) > self.MOST or self.held > self.HELD:
            self.clear()
        joined = BETWEEN.join([x.decode("utf-8", "replace") for x in raw]) + BETWEEN
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        data, ends = joined.encode("utf-8", "surrogatepass"), points == ord(BETWEEN)
        del joined
        starts = boundaries(points)
        width = 1 + (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF)
        cuts, closing = offsets(width)[:-1][starts].tolist(), np.flatnonzero(ends[starts])
        del points, width, ends
        pieces = map(data.__getitem__, map(slice, cuts[:-1], cuts[1:]))
        at = np.fromiter(map(self.at.__getitem__, pieces), np.int64, len(cuts) - 1)
        if self.at.new:
            self._learn()
        count = self.count[at]
        count[closing[:-1]] = 0  # what stands between texts
        ids = self.ids[ragged(self.start[at], count)]
        return ids, np.diff(offsets(count)[np.concatenate([[0], closing])])

    def starts(self, ids: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The byte at which each id begins within its own text; what a decoder needs to go from a byte to its id."""
        upto = offsets(self.length[ids])
        return upto[:-1] - np.repeat(upto[offsets(n)[:-1]], n)

    def decode(self, ids: np.ndarray, n: np.ndarray) -> list[bytes]:
        """Bytes of the texts whose ids stand one after another; one gather for all."""
        size = self.length[ids]
        data, cut = self.bytes[ragged(self.begin[ids], size)].tobytes(), offsets(size)[offsets(n)]
        return [data[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


@cache
def coder(path: str) -> Coder:
    """The worker's own coder for a file, kept between tasks."""
    return Coder(path)


def _blocks(raw: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """(first, texts): consecutive texts of at most BLOCK bytes together, or one longer text."""
    first, held = 0, 0
    for i, t in enumerate(raw):
        if i > first and held + len(t) > BLOCK:
            yield first, raw[first:i]
            first, held = i, 0
        held += len(t)
    if raw:
        yield first, raw[first:]


def _mapped(df: DataFrame, column: str, added: StructType | str, made) -> DataFrame:
    """``df`` without ``column`` and with what ``made(texts or lists of a block)`` gives, an array for each new column."""
    keep = [c for c in df.columns if c != column]
    schema = StructType([*df.select(*keep).schema.fields, *(added if isinstance(added, StructType) else StructType.fromDDL(added)).fields])

    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.select(keep)
            for first, new in made(batch.column(column)):
                yield pa.RecordBatch.from_arrays([*rest.slice(first, len(new[0])).columns, *new], schema.fieldNames())

    return df.mapInArrow(part, schema)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", at: str = "starts") -> DataFrame:
    """``docs`` with, in place of the text, its ids and the byte at which each begins. Names of the new columns that clash
    with another column get underscores before them."""
    new = unused([c for c in docs.columns if c != text], ids, at)

    def made(column: pa.Array):
        code = coder(path)
        for first, raw in _blocks(texts(pa.RecordBatch.from_arrays([column], [text]), text)):
            got, n = code.encode(raw)
            cut = pa.array(offsets(n), pa.int32())
            yield first, [pa.ListArray.from_arrays(cut, pa.array(x)) for x in (got.astype(np.int32), code.starts(got, n).astype(np.int32))]

    return _mapped(docs, text, f"`{new[0]}` array<int>, `{new[1]}` array<int>", made)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``df`` with the text of its ids, as bytes, in their place; null lists are empty. Unknown ids stop the job."""
    (new,) = unused([c for c in df.columns if c != ids], text)

    def made(column: pa.Array):
        code = coder(path)
        per = max(1, len(column) * BLOCK // max(1, 4 * len(column.flatten())))
        for first in range(0, len(column), per):
            own = column.slice(first, per)
            flat, n = own.flatten().to_numpy(zero_copy_only=False), own.value_lengths().fill_null(0).to_numpy()
            yield first, [pa.array(code.decode(flat.astype(np.int64), n), pa.binary())]

    return _mapped(df, ids, f"`{new}` binary", made)


def digest(ids: Column) -> Column:
    """SHA-256 of decimal ids with commas between them."""
    return F.sha2(F.concat_ws(",", F.transform(ids, lambda x: x.cast("string"))), 256)


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded by byte_bpe_multi_50k.tiktoken and decoded again: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = encode(documents(spark, sf_dir).select("doc_id", "text"), path)
    coded = coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest(F.col("ids")).alias("ids_sha256"), "ids")
    return decode(coded, path).select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))
