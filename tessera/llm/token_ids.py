"""Token ids by the public tokenizer files, through a cache of pieces.

Both vocabularies split a text at white space before any merge, so the ids of a text are the ids of its pieces one
after another. Where white space is dropped, a piece is what stands between ASCII white space, its ASCII letters in lower
case as the vocabulary has them; where it is kept, a piece begins at the text's start or at a blank that a non-space
follows. Both also split letters from the punctuation after them. Each distinct piece is encoded once per worker by the
tokenizers library; texts become ids by array gathers.
"""

from __future__ import annotations

import os
import re
import unicodedata
from itertools import chain

import numpy as np

from tessera.llm.common import offsets, ragged

#: A blank before white space, or at the end: such texts are cut by the pattern instead of a plain split.
_ODD = re.compile(r" (?:\s|$)")
_CUT = re.compile(r" (?=\S)")
_TAIL = ".,!?;:"
#: Stands before the key of a text's first piece; a lone surrogate, so no text holds it.
FIRST = "\udc00"
#: Letters below this code point are letters in every version of Unicode that a library may have.
_STABLE = "\u0530"
_CODERS: dict[tuple[str, bool], Coder] = {}


#: Bytes that byte-level vocabularies write as themselves; the others follow from code point 256 on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHER = [b for b in range(256) if b not in _PLAIN]
_LETTER = {b: chr(b) for b in _PLAIN} | {b: chr(256 + k) for k, b in enumerate(_OTHER)}


class _Numbers(dict):
    """piece -> its number; a new piece gets the next number and waits in ``new``."""

    def __init__(self):
        self.new: list[str | bytes] = []

    def __missing__(self, piece: str | bytes) -> int:
        n = self[piece] = len(self)
        self.new.append(piece)
        return n


def _grown(a: np.ndarray, need: int) -> np.ndarray:
    return a if need <= len(a) else np.concatenate([a, np.zeros(max(need, len(a)), a.dtype)])


class Coder:
    """texts -> ids of one tokenizer file; ``blank``: pieces after the first are encoded with the blank before them."""

    #: Pieces kept at most, give or take one call's; the half of them that was met most often, twice at least, then stays. It
    #: bounds a worker's memory and changes no result.
    MOST = 400_000

    def __init__(self, path: str, blank: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok, self.blank = Tokenizer.from_file(path), " " if blank else ""
        self.merge, self.lead = self.tok.model.tokenize, _LETTER[32] * blank
        special = [x.content for x in self.tok.get_added_tokens_decoder().values()]
        self.special = special if blank else [x.lower().encode() for x in special]
        self.clear()

    def clear(self) -> None:
        self.at, self.used = _Numbers(), 0
        self.start, self.size, self.ids = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), np.zeros(1 << 14, np.uint32)
        self.hits = np.zeros(1 << 12, np.int64)
        self.known = 0

    def _keep_often_met(self) -> None:
        often = np.argsort(-self.hits[: self.known], kind="stable")[: self.MOST // 2]
        kept = np.sort(often[self.hits[often] > 1])
        names, start, size, hits = list(self.at), self.start[kept], self.size[kept], self.hits[kept]
        ids = self.ids[ragged(start, size)]
        self.clear()
        self.at.update((names[k], n) for n, k in enumerate(kept.tolist()))
        self.known, self.used = len(kept), len(ids)
        self.start, self.size, self.ids, self.hits = offsets(size)[:-1], size, ids, hits // 2  # later calls count more

    def _encoded(self, pieces: list[str]) -> dict[str, list[int]]:
        """Letters alone are one word to the library's merge model; other pieces take its whole path. A piece that is
        kept with a mark before it opens its text, so no blank comes before it."""
        out = {p: [t.id for t in self.merge(self.lead + w)] for p in pieces if (w := self._spelt(p))}
        rest = [p for p in pieces if p not in out]
        whole = [p[1:] if self.blank and p[:1] == FIRST else self.blank + p for p in rest]
        out.update(zip(rest, [e.ids for e in self.tok.encode_batch(whole, add_special_tokens=False)], strict=True))
        return out

    def _spelt(self, word: str) -> str:
        """A word in the vocabulary's letters; empty if it, or what normalising makes of it, is more than letters."""
        if not word.isalpha():
            return ""
        if word.isascii():
            return word.lower() if self.tok.normalizer else word
        if self.tok.normalizer and not (max(word) < _STABLE and word == word.lower() and unicodedata.is_normalized("NFC", word)):
            word = self.tok.normalizer.normalize_str(word)
        return "".join(map(_LETTER.__getitem__, word.encode())) if word.isalpha() and max(word) < _STABLE else ""

    def _learn(self) -> None:
        """Ids for the pieces that wait: whole by the library, or those of letters and of the punctuation after them."""
        new, self.at.new = [p if self.blank else p.decode() for p in self.at.new], []
        cut = [(p, core, p[len(core) :]) if (core := p.rstrip(_TAIL)) != p and self._spelt(core) else (p, p, "") for p in new]
        key = (lambda x: x) if self.blank else str.encode
        have = lambda x: (n := self.at.get(key(x), self.known)) < self.known
        whole = list({core for _, core, _ in cut if not have(core)})
        ids = self._encoded(whole)
        tails = list({t for _, _, t in cut if t})
        after = dict(zip(tails, [e.ids for e in self.tok.encode_batch(tails, add_special_tokens=False)], strict=True)) | {"": []}

        def of(core: str) -> list[int]:
            if core in ids:
                return ids[core]
            n = self.at[key(core)]
            return self.ids[self.start[n] : self.start[n] + self.size[n]].tolist()

        got = [of(core) + after[t] for _, core, t in cut]
        lengths = np.fromiter(map(len, got), np.int64, len(got))
        where = self.used + offsets(lengths)
        last = self.known + len(got)
        self.start, self.size, self.hits, self.ids = (*(_grown(x, last) for x in (self.start, self.size, self.hits)), _grown(self.ids, int(where[-1])))
        self.start[self.known : last], self.size[self.known : last] = where[:-1], lengths
        self.ids[self.used : where[-1]] = np.fromiter(chain.from_iterable(got), np.uint32, int(lengths.sum()))
        self.known, self.used = last, int(where[-1])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, and the number of each text's ids."""
        if len(self.at) > self.MOST:
            self._keep_often_met()
        numbers: list[int] = []
        n, odd = np.zeros(len(texts), np.int64), {}
        for k, text in enumerate(texts):
            if not text:
                continue
            low = text if self.blank else text.encode().lower()
            if any(s in low for s in self.special):  # the library looks for these across the whole text
                odd[k] = np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32)
                continue
            if not self.blank:
                pieces = low.split()
            else:  # the first piece has no blank before it
                pieces = _CUT.split(text) if _ODD.search(text) else text.split(" ")
                first, pieces = pieces[0], pieces[1:]
                if first:
                    numbers.append(self.at[FIRST + first])
                n[k] = bool(first)
            numbers += map(self.at.__getitem__, pieces)
            n[k] += len(pieces)
        if self.at.new:
            self._learn()
        at = np.array(numbers, np.int64)
        self.hits[: self.known] += np.bincount(at, minlength=self.known)
        size = self.size[at]
        ids = self.ids[ragged(self.start[at], size)]
        upto = offsets(size)[np.concatenate([[0], np.cumsum(n)])]
        lengths = np.diff(upto)
        if odd:
            parts = [odd.get(k, ids[upto[k] : upto[k + 1]]) for k in range(len(texts))]
            return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        return ids, lengths


def coder(path: str, blank: bool, most: int = Coder.MOST) -> Coder:
    """The worker's own coder for a file, kept between tasks. It holds ``most`` pieces, about."""
    if (path, blank) not in _CODERS:
        _CODERS[path, blank] = Coder(path, blank)
    _CODERS[path, blank].MOST = most
    return _CODERS[path, blank]


def with_end(ids: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with one end id after each text."""
    out = np.full(len(ids) + len(lengths), end, np.uint32)
    if len(ids):
        out[np.arange(len(ids)) + np.repeat(np.arange(len(lengths)), lengths)] = ids
    return out, lengths + 1
