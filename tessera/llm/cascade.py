"""Operator 6: quality rules as a short-circuit cascade.

Each rule rejects a document by features that are computed when first asked for. On a sample, every rule is timed alone and
its rejections counted; the cascade then runs the rules by rejections per second, most first, and stops at the first that
rejects. The order changes what a document costs, never the verdict: a document is kept if no rule rejects it.

Cases: a null or empty text has no words and fails the least number of words; repeated rows get equal verdicts; a null
doc_id is kept as an id; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import documents, texts

_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\x0b\x0c\r"


class View:
    """A document's features, each computed at most once."""

    def __init__(self, text: bytes):
        self.text = text

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        """Code points in words: bytes that are neither white space nor a code point's continuation."""
        solid = np.frombuffer(self.text.translate(None, _SPACES), np.int8)
        return int(np.count_nonzero(solid >= -64))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.text) - len(self.text.translate(None, _SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines with a word."""
        return [x for x in self.text.split(b"\n") if x.strip(_SPACES)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside 3-word windows that the text has twice or more."""
        if self.n_words < 4:
            return 0
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in self.words), np.int64, self.n_words)
        pair = ids[:-1] * len(number) + ids[1:]
        if len(number) > 2_000_000:  # three numbers would not fit 63 bits
            pair = np.unique(pair, return_inverse=True)[1]
        _, at, n = np.unique(pair[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
        starts = np.flatnonzero(n[at] > 1)
        covered = np.zeros(self.n_words, bool)
        for k in range(3):
            covered[starts + k] = True
        return int(covered.sum())

    @cached_property
    def lettered(self) -> int:
        """Words with an ASCII letter or any character beyond ASCII."""
        return sum(1 for w in self.words if any(c > 64 and (c > 127 or 65 <= c & 0xDF <= 90) for c in w))


#: Rule -> whether it rejects a document.
RULES: dict[str, Callable[[View], bool]] = {
    "few_words": lambda v: v.n_words < 50,
    "repeated_words": lambda v: 100 * v.n_repeat_words > 50 * v.n_words,
    "mean_word_length": lambda v: not 2 * v.n_words <= v.word_chars <= 15 * v.n_words,
    "symbols": lambda v: 5 * v.n_symbols > v.n_words,
    "duplicate_lines": lambda v: 2 * v.n_dup_lines > len(v.lines),
    "words_without_letters": lambda v: 10 * v.lettered < 6 * v.n_words,
}


def measure(docs: DataFrame, rules: dict[str, Callable] = RULES, rows: int = 2000) -> dict[str, tuple[float, float]]:
    """rule -> (rejected share, seconds a document), each rule alone, on about ``rows`` sampled documents."""
    n = docs.count()
    some = docs.select("text") if n <= rows else docs.select("text").sample(fraction=rows / n, seed=7)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for name, rejects in rules.items():
                began = time.perf_counter()
                bad = sum(bool(rejects(View(t))) for t in texts(batch))
                got.append((name, batch.num_rows, bad, time.perf_counter() - began))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*got, strict=True)], ["rule", "n", "bad", "s"])

    sums = some.mapInArrow(run, "rule string, n long, bad long, s double").groupBy("rule").agg(F.sum("n"), F.sum("bad"), F.sum("s")).collect()
    return {r: (bad / n, s / n) for r, n, bad, s in sums}  # a row for each rule


def ordered(stats: dict[str, tuple[float, float]], rules: dict[str, Callable] = RULES) -> list[str]:
    """Rules by rejections per second, most first; unmeasured ones last."""
    return sorted(rules, key=lambda r: -stats[r][0] / max(stats[r][1], 1e-9) if r in stats else 1)


def first_rejection(view: View, order: list[str], rules: dict[str, Callable] = RULES) -> str | None:
    return next((r for r in order if rules[r](view)), None)


def cascade(docs: DataFrame, rules: dict[str, Callable] = RULES) -> DataFrame:
    """doc_id, the counts of the rules' features, base_failed and kept, for every document."""
    order = ordered(measure(docs, rules), rules)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            views = [View(t) for t in texts(batch)]
            kept = [first_rejection(v, order, rules) is None for v in views]  # before any other feature is asked for
            counts = [pa.array([getattr(v, x) for v in views], pa.int64()) for x in names]
            failed = [v.n_words < 50 or 100 * v.n_repeat_words > 50 * v.n_words for v in views]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, pa.array(failed), pa.array([k and not f for k, f in zip(kept, failed, strict=True)])], ["doc_id", *names, "base_failed", "kept"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, " + "".join(f"{x} long, " for x in names) + "base_failed boolean, kept boolean")


def op6_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade(documents(spark, sf_dir))


#: The same for DuckDB; the rules' verdicts are spelt out.
SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), f AS (
  SELECT doc_id, t, w, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
    CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: concat_ws(' ', w[i], w[i + 1], w[i + 2])) ELSE [] END AS g
  FROM d
), r AS (
  SELECT doc_id, count(*) AS n_repeat_words FROM (
    SELECT DISTINCT doc_id, p + k AS p FROM (
      SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, s) AS n
      FROM (SELECT doc_id, unnest(g) AS s, generate_subscripts(g, 1) AS p FROM f)
    ), (VALUES (0), (1), (2)) AS v(k) WHERE n > 1
  ) GROUP BY doc_id
), a AS (
  SELECT f.doc_id, n_words, word_chars, n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS lettered
  FROM f LEFT JOIN r ON f.doc_id = r.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR 5 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR 10 * lettered < 6 * n_words) AS kept
FROM a
"""
