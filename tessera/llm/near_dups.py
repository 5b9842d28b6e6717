"""Operator 10: near duplicates by bottom-k sketches from one hash function.

A document's sketch is the K smallest 64-bit hashes of its distinct shingles. Documents with equal shingle sets become one
class first. Inverted lists of parts of sketches give candidate pairs; the sketch of a pair's union estimates its
similarity and filters; the exact Jaccard of the full sets, from the texts, confirms every link. Components of links are the
groups.

A list is known by several retained hashes that stand together, not by one, so that few texts meet by chance and lists
with more than one member grow with the similar texts, not with the square of the input:
- A set of up to K shingles is held whole. Two similar ones of a range of sizes differ in d hashes at most, so when all are dealt to
  slots, d slots at most differ, and of the d + COMMON slots that come first in one order of contents, COMMON are the same in
  both (one, of very small sets). Each set opens a list for each of these, in every range that it can be in. This is exact.
- Where one of two sets may be larger, a list holds the hashes from one mark (every third hash is one) to the next. Two sets of
  similarity 0.8 have 119 marks and differences, in any order, where their sketches overlap; fewer than two lists in common take that marks
  hardly ever follow each other there, a probability of 1e-12.

No list is expanded into all its pairs:
- First every list links its members to one leader only: that whose lists have most members, which edited copies
  share with their source; then, among what is still apart, to another. These rounds collapse groups of copies.
- Then, where a list still holds several components, members outside its largest component meet the members of other
  components. Members of one component never meet. This step is what makes the links complete. Similar sets share one list
  more than they need to, so that of each set the list of most members is left out.
- In a list of more than HOT members of which one component has half, all are held against the text of that component with most
  in common with others, its leader. A set that is similar to the leader is linked to it. Any other differs from the leader
  by more than it may differ from a similar set, so the two share some of these differences: rare ones, by the prefix filter
  on the differences. Copies with edits of their own hardly ever do, so the edited copies of a text do not all meet.

Sets of up to K = 256 shingles are compared whole. Of two larger ones of
similarity 0.8, the union's K smallest hashes hold fewer than LEAST = 160 shared ones (204.8 expected, deviation 6.4) with
probability 1e-11.

Cases: a null, empty or blank text has no shingles, is its own component and kept; fewer words than a shingle make one
shingle; a null doc_id is never linked, its component_id is null and it is kept; rows that share a doc_id are one node,
each with its own n_shingles, and ``keep_first`` keeps that of least hashes (of its text, then of all columns); an empty
table gives no rows; extra columns pass through ``keep_first`` untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, blocks, components, documents, maybe_among, mixed, offsets, texts, tidied, unused, words

K, LEAST, COMMON, MARKS, HOT = 256, 160, 3, 3, 32


def shingle_hashes(raw: list[bytes], width: int) -> list[np.ndarray]:
    """Of each text: the sorted distinct 64-bit hashes of its shingles of ``width`` lower-cased words."""
    text, _, h = words(raw)
    many = np.bincount(text, minlength=len(raw))
    start = offsets(many)
    size = np.minimum(many, width)  # a shorter text is one shingle
    with np.errstate(over="ignore"):
        out = np.repeat(size, many).astype(np.uint64)
        for j in range(min(width, len(h))):
            later = mixed(out[: len(h) - j] * np.uint64(0x9E3779B97F4A7C15) + h[j:])
            within = np.repeat(size, many)[: len(h) - j] > j
            out[: len(h) - j] = np.where(within, later, out[: len(h) - j])
    count = np.where(many, many - size + 1, 0)
    return [np.unique(out[a : a + n]) for a, n in zip(start.tolist(), count.tolist(), strict=False)]


def shingle_codes(raw: list[bytes], width: int) -> list[np.ndarray]:
    """The shingle sets of texts as sorted distinct numbers: equal in these texts if and only if the shingles are."""
    number: dict[bytes, int] = {}
    ids = [np.fromiter((number.setdefault(w, len(number)) for w in t.lower().split()), np.int64) for t in raw]
    size = [min(width, len(x)) for x in ids]
    out = [x[: len(x) - k + 1 if k else 0] for x, k in zip(ids, size, strict=True)]
    for j in range(1, width):
        _, code = np.unique(np.concatenate(out), return_inverse=True)  # stays below the number of words
        cut = offsets(np.array([len(x) for x in out], np.int64))
        out = [(code[a:b] + 1) * (len(number) + 1) + (x[j : j + b - a] + 1 if j < k else 0) for a, b, x, k in zip(cut[:-1], cut[1:], ids, size, strict=True)]
    return [np.unique(x) for x in out]


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have that similarity."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def needed(n: int, percent: int) -> int:
    """Retained hashes that a document of n shingles shares with any similar one; above K, all but surely."""
    if n > K:
        return LEAST
    others = range(-(-percent * n // 100), 100 * n // percent + 1)  # the sizes that similar sets can have
    return min((-(-percent * (n + m) // (100 + percent)) - max(0, m - K) for m in others), default=n)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, th (text hash), n, d1, d2 (digest of the shingle set), sketch (little-endian hashes, ascending)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_intdigest

        for batch in batches:
            n, digest, sketch = [], [], []
            for _, raw in blocks(texts(batch)):
                for s in shingle_hashes(raw, width):
                    n.append(len(s))
                    digest.append(xxh3_128_intdigest(s.tobytes()))
                    sketch.append(s[:K].tobytes())
            d = [np.array([x >> k & (2**64 - 1) for x in digest], np.uint64).view(np.int64) for k in (64, 0)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(n, pa.int64()), pa.array(d[0]), pa.array(d[1]), pa.array(sketch, pa.binary())], ["doc_id", "th", "n", "d1", "d2", "sketch"])

    return docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(tidied(run), "doc_id long, th long, n long, d1 long, d2 long, sketch binary")


def ranges(percent: int) -> list[tuple[int, int, int]]:
    """(least, most, d) of ranges of sizes up to K: two similar sets of up to K are both in one of them, and sets of one that are
    similar differ in d hashes at most."""
    out, low = [], 1
    while low <= K:
        after = max(low + 1, -(-low * 7 // 5))  # the smaller set's size is below
        most = min(K, 100 * (after - 1) // percent)
        differ = max(n - 2 * -(-percent * n // (100 + percent)) for n in range(2 * low, min(after - 1, K) + most + 1))
        if differ > 0:  # else similar sets are equal
            out.append((low, most, differ))
        low = after
    return out


def common(differ: int) -> int:
    """Lists that two sets of up to K share at least, if they differ in so many hashes at most."""
    return COMMON if differ > 3 else 1


def list_keys(v: np.ndarray, n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner, key) of the lists that sketches open: ``v`` holds the hashes one sketch after another, ascending, n the sizes of
    the sets."""
    by_slots, by_marks = slot_keys(v, n, percent), mark_keys(v, n, percent)
    return np.concatenate([by_slots[0], by_marks[0]]), np.concatenate([by_slots[1], by_marks[1]])


def slot_keys(v: np.ndarray, n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The lists of sets of up to K, by their slots."""
    size = np.minimum(n, K)
    own, owners, keys = np.repeat(np.arange(len(n)), size), [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    with np.errstate(over="ignore"):
        h = mixed(v ^ np.uint64(0x5DEECE66D))
        for j, (low, most, differ) in enumerate(ranges(percent), 1):
            those = ((n >= low) & (n <= most))[own]
            if not those.any():
                continue
            slots, most_of = differ + common(differ) + 1 + differ // 4, differ + common(differ)
            slot = (v[those] % np.uint64(slots)).astype(np.int64)
            each, at = np.unique(own[those], return_inverse=True)
            cell = at * slots + slot
            many = np.bincount(cell, minlength=len(each) * slots)
            digest = np.zeros(len(each) * slots, np.uint64)
            np.add.at(digest, cell, h[those])
            name = mixed(np.tile(np.arange(slots, dtype=np.uint64) << np.uint64(8), len(each)) + np.uint64(j))
            key = mixed(mixed(digest + many.astype(np.uint64)) ^ name).reshape(-1, slots)
            # those of most hashes first, any order of contents will do: few texts share several by chance
            order = np.lexsort((key, -many.reshape(-1, slots)), axis=1)[:, :most_of]
            owners.append(np.repeat(each, most_of))
            keys.append(np.take_along_axis(key, order, 1).ravel())
    return np.concatenate(owners), np.concatenate(keys)


def mark_keys(v: np.ndarray, n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The lists for pairs with a set above K, by the hashes between marks."""
    own = np.repeat(np.arange(len(n)), np.minimum(n, K))
    with np.errstate(over="ignore"):
        h = mixed(v ^ np.uint64(0x5DEECE66D))
        mark = np.flatnonzero((h % np.uint64(MARKS) == 0) & (n >= -(-percent * (K + 1) // 100))[own])
        a, b = mark[:-1], mark[1:]
        a, b = (x[own[a] == own[b]] for x in (a, b))
        upto = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h, out=upto[1:])
        return own[a], mixed(upto[b + 1] - upto[a])


def lists(reps: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(value, rep, n, marks, hub): the inverted lists of more than one class. marks: a list by marks; hub sums the members of all lists of the class: of a
    group of edited copies the text they were made from has the highest."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 2048):
                batch = whole.slice(i, 2048)
                n, rep = batch.column("n").to_numpy(), batch.column("rep").to_numpy()
                v = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint64)
                for marks, keys in enumerate((slot_keys, mark_keys)):
                    own, key = keys(v, n, percent)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(rep[own]), pa.array(n[own]), pa.array(np.full(len(own), bool(marks)))], ["value", "rep", "n", "marks"])

    opened = reps.select("rep", "n", "sketch").mapInArrow(tidied(run), "value long, rep long, n long, marks boolean")
    shared = opened.withColumn("many", F.count("*").over(Window.partitionBy("value"))).where("many > 1")
    shared = scratch.save(shared, "shared")
    hubs = shared.groupBy(F.col("rep").alias("r")).agg(F.sum("many").alias("hub"))
    out = scratch.save(shared.join(hubs, F.col("rep") == F.col("r")).select("value", "rep", "n", "marks", "hub"), "lists")
    scratch.drop(shared)
    return out


def similar_sketches(a: bytes, b: bytes, n: int, m: int, percent: int) -> bool:
    """Whether the sketch of the union leaves the similarity possible: exact for sets that are held whole."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = np.intersect1d(x, y, assume_unique=True)
    if n <= K and m <= K:
        return 100 * len(both) >= percent * (len(x) + len(y) - len(both))
    if len(both) < min(needed(n, percent), needed(m, percent)):
        return False
    union = np.union1d(x, y)[:K]
    return np.searchsorted(both, union[-1], side="right") >= LEAST


def confirm(pairs: DataFrame, reps: DataFrame, docs: DataFrame, width: int, percent: int, scratch: Scratch) -> DataFrame:
    """The links (a, b) among candidate pairs: first by sketches, then by the full sets of the texts."""
    pairs = scratch.save(pairs, "pairs")
    # sketches and texts outside the pairs stay where they are: a bitmap of fixed size tells before the shuffle
    some = maybe_among(reps, "rep", pairs.select("a").union(pairs.select("b"))).where("_among")
    side = lambda x: some.select(F.col("rep").alias(x), F.col("th").alias(f"th_{x}"), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b").where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")

    def estimate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {x: batch.column(x).to_pylist() for x in ("s_a", "s_b", "n_a", "n_b")}
            ok = [similar_sketches(*x, percent) for x in zip(c["s_a"], c["s_b"], c["n_a"], c["n_b"], strict=True)]
            yield batch.filter(pa.array(ok, pa.bool_())).select(["a", "th_a", "b", "th_b"])

    near = scratch.save(near.mapInArrow(tidied(estimate), "a long, th_a long, b long, th_b long"), "near")
    wanted = near.select(F.col("a").alias("id"), F.col("th_a").alias("h")).union(near.select("b", "th_b")).distinct()
    wanted = scratch.save(wanted, "wanted")
    keyed = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    held = maybe_among(keyed, "doc_id", wanted.select("id")).where("_among").drop("_among")
    held = held.join(wanted, (F.col("doc_id") == F.col("id")) & (F.col("th") == F.col("h")), "left_semi")
    held = scratch.save(held.dropDuplicates(["doc_id", "th"]), "texts")
    text = lambda x: held.select(F.col("doc_id").alias(x), F.col("th").alias(f"th_{x}"), F.col("text").alias(f"text_{x}"))
    both = near.join(text("a"), ["a", "th_a"]).join(text("b"), ["b", "th_b"]).select("a", "b", "text_a", "text_b")

    def exact(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Hashes of the full sets tell which pairs are too far apart; the others' shingles themselves are compared."""
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                batch, ok = whole.slice(i, 256), []
                left, right = texts(batch, "text_a"), texts(batch, "text_b")
                each = list(dict.fromkeys(left + right))
                hashed = dict(zip(each, (h for _, raw in blocks(each) for h in shingle_hashes(raw, width)), strict=True))
                for s, t in zip(left, right, strict=True):
                    near = _similar(hashed[s], hashed[t], percent)
                    ok.append(near and _similar(*shingle_codes([s, t], width), percent))
                yield batch.filter(pa.array(ok, pa.bool_())).select(["a", "b"])

    links = scratch.save(both.mapInArrow(tidied(exact), "a long, b long"), "links")
    scratch.drop(pairs, near, wanted, held)
    return links


def groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Every row's doc_id, n_shingles and component_id (the smallest doc_id of its group)."""
    scratch = Scratch(docs.sparkSession, "near")
    base = scratch.save(sketches(docs, width), "sketches")
    linked = base.where("n > 0 and doc_id is not null")
    reps = linked.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "th", "n", "sketch")).alias("x"))
    reps = scratch.save(reps.select("d1", "d2", F.col("x.doc_id").alias("rep"), "x.th", "x.n", "x.sketch"), "classes")
    members = scratch.save(base.select("doc_id", "n", "d1", "d2"), "members")
    scratch.drop(base)
    table = lists(reps, percent, scratch)
    roots = None
    for seed in (1, 2):
        first_by = -F.col("hub") if seed == 1 else F.xxhash64("rep")
        lead = F.struct(first_by.alias("h"), F.col("rep").alias("a"), F.col("n").alias("m"))
        leaders = table.groupBy(F.col("value").alias("v")).agg(F.min(lead).alias("lead")).select("v", "lead.a", "lead.m")
        pairs = table.join(leaders, F.col("value") == F.col("v")).where(f"rep <> a and 100 * least(n, m) >= {percent} * greatest(n, m)").select("a", F.col("rep").alias("b"))
        if roots is not None:
            pairs = _apart(pairs, roots)
        pairs = pairs.groupBy("a", "b").count().where(f"count >= {COMMON}").select("a", "b")
        roots = _joined(roots, confirm(pairs, reps, docs, width, percent, scratch), scratch)
    roots = _joined(roots, confirm(_crossing(table, roots, reps, percent, scratch), reps, docs, width, percent, scratch), scratch)
    # rows that share a doc_id are one node, whatever their texts
    first = members.join(reps.select(F.col("d1").alias("e1"), F.col("d2").alias("e2"), "rep"), (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")) & F.expr("n > 0 and doc_id is not null"), "left")
    first = scratch.save(first.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("rep", "doc_id").alias("rep")), "nodes")
    repeated = first.where("doc_id is not null").groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b")
    roots = _joined(roots, repeated.select("a", "b").union(repeated.select("a", F.col("doc_id").alias("b")).where("a <> b")), scratch)
    out = first.join(roots, F.col("rep") == F.col("node"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("root", "rep").alias("component_id"))


def _joined(roots: DataFrame | None, links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) after more links: only the roots that these connect are moved."""
    if roots is None:
        return components(links, scratch)
    side = lambda x: roots.select(F.col("node").alias(f"node_{x}"), F.col("root").alias(f"root_{x}"))
    more = links.join(side("a"), F.col("a") == F.col("node_a"), "left").join(side("b"), F.col("b") == F.col("node_b"), "left")
    more = components(more.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")), scratch)
    new = more.select(F.col("node").alias("old"), F.col("root").alias("new"))
    moved = roots.join(new, F.col("root") == F.col("old"), "left").select("node", F.coalesce("new", "root").alias("root"))
    return scratch.save(moved.union(more.join(roots, "node", "left_anti")), "roots")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose ends are not in one component yet."""
    side = lambda x: roots.select(F.col("node").alias(f"node_{x}"), F.col("root").alias(f"root_{x}"))
    out = pairs.join(side("a"), F.col("a") == F.col("node_a"), "left").join(side("b"), F.col("b") == F.col("node_b"), "left")
    return out.where("coalesce(root_a, a) <> coalesce(root_b, b)").select("a", "b")


def _crossing(table: DataFrame, roots: DataFrame, reps: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs of different components that share enough lists."""
    known = table.join(roots, F.col("rep") == F.col("node"), "left").select("value", "rep", "n", "marks", "hub", F.coalesce("root", "rep").alias("comp"))
    known = scratch.save(known, "placed")
    per = known.groupBy("value", "comp").agg(F.count("*").alias("many"))
    live = per.groupBy(F.col("value").alias("v")).agg(F.max(F.struct("many", "comp")).alias("x"), F.count("*").alias("comps"), F.sum("many").alias("all")).where("comps > 1")
    live = known.join(live.select("v", F.col("x.comp").alias("major"), "all", F.expr(f"all > {HOT} and 2 * x.many >= all").alias("led")), F.col("value") == F.col("v")).drop("v")
    live = scratch.save(live.withColumn("led", F.expr("led and not marks")), "live")
    scratch.drop(known)
    led, rest = _beside_leaders(live.where("led"), reps, percent, scratch), live.where("not led")
    # sets of ``solid`` or more share COMMON lists with similar ones of ``solid`` or more, two if by marks: one can be left out
    solid = min((low for low, _, d in ranges(percent) if common(d) == COMMON), default=K + 1)
    most = rest.where(f"marks or {percent} * n > 100 * {solid - 1}").groupBy(F.col("rep").alias("r"), "marks").agg(F.max(F.struct("all", "value")).alias("x"))
    rest = scratch.save(rest.join(most.select("r", F.col("x.value").alias("v")), F.expr("rep = r and value = v"), "left_anti"), "rest")
    x = rest.where("comp <> major").select(F.col("value").alias("vx"), F.col("rep").alias("x"), F.col("comp").alias("cx"), F.col("n").alias("nx"))
    y = rest.select("value", F.col("rep").alias("y"), F.col("comp").alias("cy"), F.col("n").alias("ny"), "marks", (F.col("comp") == F.col("major")).alias("in_major"))
    near = F.expr(f"vx = value and cx <> cy and (in_major or x < y) and 100 * least(nx, ny) >= {percent} * greatest(nx, ny) and (not marks or greatest(nx, ny) > {K})")
    need = F.expr(f"if(marks or least(nx, ny) < {solid}, 1, {COMMON - 1})")
    pairs = x.join(y, near).groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.count("*").alias("shared"), F.min(need).alias("need"))
    pairs = pairs.where("shared >= need").select("a", "b")
    return pairs if led is None else pairs.union(led).distinct()


def apart(n, m, percent: int):
    """Hashes by which similar sets of n and m differ at most."""
    return n + m - 2 * -(-percent * (n + m) // (100 + percent))


@lru_cache(1 << 16)
def prefixes(n: int, d: int, lead: int, percent: int) -> tuple[int, int]:
    """Of a set of n that differs in d hashes from its leader, a set of ``lead``: how many of the d, the rarest, have one in
    common with a similar set. First for a set that is not similar to the leader and any other; then for any set, and others
    that are not similar to the leader."""
    m = np.arange(-(-percent * n // 100), min(K, 100 * n // percent) + 1)  # the sizes that similar sets can have
    most = apart(n, m, percent)
    other = np.maximum(abs(m - lead), d - most)  # the other's differences from the leader at least
    far = np.maximum(other, apart(m, lead, percent) + 1)
    # similar sets share half of what they differ from the leader in beyond ``most``
    return tuple(d + 1 - max(1, int(np.min(-(-(d + x - most) // 2)))) for x in (other, far))


def _beside_leaders(led: DataFrame, reps: DataFrame, percent: int, scratch: Scratch) -> DataFrame | None:
    """Pairs (a, b) among the members of lists (all of sets up to K) that one component leads: all that are similar and in
    different components, or become so by a link to a leader. None if there are no such lists."""
    members = scratch.save(led.groupBy("major", "rep").agg(F.first("n").alias("n"), F.first("comp").alias("comp"), F.first("hub").alias("hub")), "led")
    if members.isEmpty():
        return None
    some = maybe_among(reps, "rep", members.select("rep").distinct()).where("_among").select(F.col("rep").alias("r"), "sketch")
    own = members.join(some, F.col("rep") == F.col("r")).select("major", "rep", "n", "comp", "hub", "sketch")
    leaders = own.where("comp = major").groupBy(F.col("major").alias("of")).agg(F.max(F.struct("hub", "rep", "n", "sketch")).alias("l"))
    both = own.join(leaders.select("of", F.col("l.rep").alias("lead"), F.col("l.n").alias("m"), F.col("l.sketch").alias("other")), F.col("major") == F.col("of"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {x: batch.column(x).to_pylist() for x in ("n", "m", "sketch", "other")}
            differ = [np.setxor1d(*(np.frombuffer(x, np.int64) for x in pair), assume_unique=True) for pair in zip(c["sketch"], c["other"], strict=True)]
            d = [len(x) for x in differ]
            far = [k > apart(n, m, percent) for k, n, m in zip(d, c["n"], c["m"], strict=True)]
            first = [prefixes(n, k, m, percent) for n, k, m in zip(c["n"], d, c["m"], strict=True)]
            columns = [pa.array(far, pa.bool_()), pa.array(d, pa.int64()), *(pa.array([x[j] for x in first], pa.int64()) for j in (0, 1)), pa.array(differ, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("major", "rep", "comp", "n", "lead")), *columns], ["major", "rep", "comp", "n", "lead", "far", "d", "px", "py", "es"])

    found = both.select("major", "rep", "comp", "n", "lead", "m", "sketch", "other").mapInArrow(tidied(run), "major long, rep long, comp long, n long, lead long, far boolean, d long, px long, py long, es array<long>")
    found = scratch.save(found, "differing")
    each = found.select("major", "rep", "comp", "n", "far", "d", "px", "py", F.explode("es").alias("e"))
    counts = each.groupBy(F.col("major").alias("mc"), F.col("e").alias("ec")).agg(F.count("*").alias("many")).where("many > 1")  # the others are met by none
    by = Window.partitionBy("major", "rep")
    place = F.row_number().over(by.orderBy("many", "e")) + F.col("d") - F.count("*").over(by)
    held = each.join(counts, F.expr("major = mc and e = ec")).withColumn("place", place).where("place <= if(far, greatest(px, py), py)")
    held = scratch.save(held.select("major", "e", "rep", "comp", "n", "far", "place", "px", "py"), "held")
    x = held.where("far and place <= px").select(F.col("major").alias("gx"), F.col("e").alias("ex"), F.col("rep").alias("x"), F.col("comp").alias("cx"), F.col("n").alias("nx"))
    y = held.where("place <= py").select("major", "e", F.col("rep").alias("y"), F.col("comp").alias("cy"), F.col("n").alias("ny"), F.col("far").alias("fy"))
    near = F.expr(f"gx = major and ex = e and cx <> cy and (not fy or x < y) and 100 * least(nx, ny) >= {percent} * greatest(nx, ny)")
    pairs = x.join(y, near).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return pairs.union(found.where("not far and comp <> major").select(F.least("rep", "lead").alias("a"), F.greatest("rep", "lead").alias("b"))).distinct()


def keep_first(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group (that of the smallest doc_id, once), with all its columns."""
    one = groups(docs, width, percent).where("doc_id is null or doc_id = component_id")
    columns = docs.columns
    text_hash, row_hash, kept, best = unused(columns, "text_hash", "row_hash", "kept", "best")
    odd = [c for c, kind in docs.dtypes if "map<" in kind or "variant" in kind]  # these have no hash, but a text
    plain = [F.col(c) for c in columns if c not in odd] + [F.to_json(F.struct(F.col(c))) for c in odd]
    hashed = docs.where(docs["doc_id"].isNotNull()).withColumns({text_hash: F.xxhash64("text"), row_hash: F.xxhash64(*plain)})
    first = hashed.groupBy(F.col("doc_id").alias(kept)).agg(F.min(F.struct(text_hash, row_hash)).alias(best))
    first = first.join(one.where("doc_id is not null").select(F.col("doc_id").alias(kept)).distinct(), kept)
    same = (hashed["doc_id"] == F.col(kept)) & (F.col(text_hash) == F.col(f"{best}.{text_hash}")) & (F.col(row_hash) == F.col(f"{best}.{row_hash}"))
    with_id = hashed.join(first, same, "left_semi").dropDuplicates(["doc_id"]).select(*columns)  # only equal rows are left
    return with_id.unionByName(docs.where(docs["doc_id"].isNull()))


def op10_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = groups(documents(spark, sf_dir), width=2)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
