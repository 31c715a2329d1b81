"""Runs of repeated words inside a document, as maximal pairs of its suffixes.

Two places of a text form a maximal pair if the words from both on agree for ``l`` words, the next
words differ and the words before differ.  At distance ``d`` such a pair is the stretch of ``l + d``
words from the first place on, which has period ``d`` and cannot be extended: with ``l + d >= max(6,
4 d)`` it is a run, and nothing needs to be extended.

1. The suffixes of all texts of a batch are sorted by doubling; only groups that are still equal
   are sorted again.  The group numbers of each round give the common prefix of neighbours.
2. The LCP-interval tree of each stretch of neighbours with a common prefix of ``LEAST`` words is
   walked bottom-up.  An interval keeps its places in one sorted list for each word before them.
   Where a child joins, its places meet those of the other classes at a distance of at most a
   third of the interval's depth, found by bisection or by distance, whichever is shorter.  The
   smaller side is the one that is walked and moved.
3. A stretch found at several multiples of its period is kept at the smallest.

A text is worked on by itself, so nothing is shuffled.

Edge cases: a null or empty text has no word and no run, and the digest of the empty string; a
null ``doc_id`` has no number to derive a shape from, so ``shape`` leaves its words alone; repeated
rows are worked on one by one; a very long text is one row's work, with memory in proportion to its
words; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.llm.shared import batches, table

LEAST_WORDS = 6
LEAST_EXPONENT = 4
# shortest common prefix of a run's first two periods: at period 1 six words are needed
LEAST = LEAST_WORDS - 1
# text that is sorted at once, unless one text is longer
BATCH_BYTES = 4 << 20

_RUNS = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long,"
    " runs_sha256 string, collapsed_sha256 string, runs array<struct<start:long,length:long,period:long>>, collapsed string"
)


def sorted_suffixes(keys: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in sorted order, and for round ``j`` the groups of suffixes equal in ``2 ** j`` words.

    Each text ends with a key of its own, so that equal stretches never pass its end.
    """
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    rank = np.empty(n, np.int64)

    def regroup(slots: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Number the suffixes at ``slots`` by the first slot of equal ``values``; slots of groups of several."""
        change = np.append(True, values[1:] != values[:-1])
        firsts = np.flatnonzero(change)
        sizes = np.diff(np.append(firsts, len(slots)))
        rank[order[slots]] = np.repeat(slots[firsts], sizes)
        return slots[np.repeat(sizes > 1, sizes)]

    slots = regroup(np.arange(n), keys[order]) if n else np.empty(0, np.int64)
    rounds, k = [rank.astype(np.int32)], 1
    while len(slots):
        places = order[slots]
        values = rank[places] * n + rank[places + k]
        by = np.argsort(values, kind="stable")
        order[slots] = places[by]
        slots = regroup(slots, values[by])
        rounds.append(rank.astype(np.int32))
        k *= 2
    return order, rounds


def common_prefixes(order: np.ndarray, rounds: list[np.ndarray]) -> np.ndarray:
    """Length of the common prefix of each suffix in ``order`` and the one before it."""
    lcp = np.zeros(len(order), np.int64)
    # each round adds its words where both sides are still in one group
    same = np.arange(1, len(order))
    for j in range(len(rounds) - 1, -1, -1):
        a, b = order[same - 1] + lcp[same], order[same] + lcp[same]
        # ends of texts are keys of their own, so neither side passes the last key
        lcp[same[rounds[j][a] == rounds[j][b]]] += 1 << j
    return lcp


class Interval:
    """An LCP interval: its depth and its places by the word before them."""

    __slots__ = ("depth", "left", "classes")

    def __init__(self, depth: int, left: dict[int, int], classes: dict[int, list[int]]):
        self.depth, self.left, self.classes = depth, left, classes

    def absorb(self, child: Interval, found: Callable[[int, int, int], None]) -> None:
        """Take the places of ``child`` in, and report its maximal pairs with those already here."""
        reach = self.depth // (LEAST_EXPONENT - 1)
        large, small = self, child
        if len(large.left) < len(small.left):
            large, small = small, large
        for p, own in small.left.items():
            if len(large.classes) <= 2 * reach:
                for word, places in large.classes.items():
                    if word != own:
                        for q in places[bisect_left(places, p - reach) : bisect_right(places, p + reach)]:
                            found(p, q, self.depth)
            else:
                for q in (*range(p - reach, p), *range(p + 1, p + reach + 1)):
                    if large.left.get(q, own) != own:
                        found(p, q, self.depth)
        large.left.update(small.left)
        for word, places in small.classes.items():
            into = large.classes.setdefault(word, [])
            for p in places:
                insort(into, p)
        self.left, self.classes = large.left, large.classes


def pairs_of_block(places: list[int], lcp: list[int], left: list[int], found: Callable[[int, int, int], None]) -> None:
    """Report the maximal pairs within reach among neighbouring suffixes; ``lcp[0]`` is not used."""
    stack: list[Interval] = []
    for i, (p, word) in enumerate(zip(places, left, strict=True)):
        current = Interval(0, {p: word}, {word: [p]})
        depth = lcp[i + 1] if i + 1 < len(places) else 0
        while stack and stack[-1].depth > depth:
            parent = stack.pop()
            parent.absorb(current, found)
            current = parent
        if stack and stack[-1].depth == depth:
            stack[-1].absorb(current, found)
        else:
            stack.append(Interval(depth, current.left, current.classes))


def runs_of(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(text, start, length, period) of all runs of texts, whose word numbers stand in ``ids`` one after the other."""
    n_texts = len(lengths)
    if not n_texts or not len(ids):
        return []
    # an own key at the end of each text, and no key in two texts
    width = int(ids.max()) + 2
    text = np.repeat(np.arange(n_texts), lengths + 1)
    ends = np.cumsum(lengths + 1) - 1
    keys = np.zeros(len(text), np.int64)
    inside = np.ones(len(text), bool)
    inside[ends] = False
    keys[inside] = ids + 1
    keys += text * width
    order, rounds = sorted_suffixes(keys)
    lcp = common_prefixes(order, rounds)
    deep = lcp >= LEAST
    if not deep.any():
        return []
    begins = ends - lengths
    # stretches of neighbours with a deep common prefix; the slot before the first deep one belongs to it
    member = deep | np.append(deep[1:], False)
    slots = np.flatnonzero(member)
    block = np.cumsum(~deep[slots]) - 1
    # a stretch whose places are all too far apart for its deepest prefix holds no pair
    places = order[slots]
    by = np.lexsort((places, block))
    gaps = np.diff(places[by], prepend=0)
    firsts = np.flatnonzero(~deep[slots])
    gaps[firsts] = len(keys)
    near = np.minimum.reduceat(gaps, firsts)
    depth = lcp[slots].copy()
    depth[firsts] = 0
    deepest = np.maximum.reduceat(depth, firsts)
    best: dict[tuple[int, int], int] = {}

    def found(p: int, q: int, length: int) -> None:
        period = abs(p - q)
        if length + period >= max(LEAST_WORDS, LEAST_EXPONENT * period):
            stretch = (min(p, q), length + period)
            best[stretch] = min(best.get(stretch, period), period)

    bounds = np.append(firsts, len(slots))
    for b in np.flatnonzero(near * (LEAST_EXPONENT - 1) <= deepest).tolist():
        a, z = bounds[b], bounds[b + 1]
        own = places[a:z]
        # the first word of a text has no word before it, which differs from every word
        before = np.where(own == begins[text[own]], -1, keys[own - 1])
        pairs_of_block(own.tolist(), depth[a:z].tolist(), before.tolist(), found)
    return sorted((int(text[p]), p - int(begins[text[p]]), length, period) for (p, length), period in best.items())


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts one after the other, and the number of words of each text."""
    trimmed = pc.ascii_trim_whitespace(texts.fill_null(""))
    lists = pc.ascii_split_whitespace(trimmed)
    counts = np.diff(np.asarray(lists.offsets)).astype(np.int64)
    # an empty text splits into one empty word
    counts[np.asarray(pc.binary_length(trimmed)) == 0] = 0
    words = lists.flatten()
    return words.filter(pc.greater(pc.binary_length(words), 0)), counts


def shape(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(first place, period) of the repetition that the query's contract puts into a tenth of the texts."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return None
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _summary(runs: list[tuple[int, int, int]]) -> tuple:
    """Columns of one text from its runs (start, length, period), sorted by start and period."""
    if not runs:
        return (0, None, None, None, None, _sha(b""))
    best = runs[0]
    for run in runs[1:]:
        # exponents are compared as fractions; the earlier run stays at a tie
        if run[1] * best[2] > best[1] * run[2]:
            best = run
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    return (len(runs), *best, 1000 * best[1] // best[2], _sha(lines.encode()))


def _detect(shaped: bool, with_text: bool):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        doc_ids = batch.column(0).to_pylist()
        words, counts = split_words(batch.column(1))
        starts = np.cumsum(counts) - counts
        at = np.arange(len(words))
        if shaped:
            for doc_id, start, n in zip(doc_ids, starts.tolist(), counts.tolist(), strict=True):
                if (put := shape(doc_id, n)) is not None:
                    a, period = put
                    at[start + a : start + n] = start + a + np.arange(n - a) % period
        ids = np.asarray(words.dictionary_encode().indices).astype(np.int64)[at]
        runs: list[list[tuple[int, int, int]]] = [[] for _ in doc_ids]
        kept = np.ones(len(at), bool)
        for text, start, length, period in runs_of(ids, starts, counts):
            runs[text].append((start, length, period))
            kept[starts[text] + start + period : starts[text] + start + length] = False
        left = np.add.reduceat(np.append(kept, False), starts) if len(starts) else starts
        left = np.where(counts > 0, left, 0)
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(left)), pa.int32()), words.take(pa.array(at[kept])))
        collapsed = pc.binary_join(lists, " ")
        out = [(doc_id, *_summary(own), _sha(c.as_buffer().to_pybytes())) for doc_id, own, c in zip(doc_ids, runs, collapsed, strict=True)]
        types = [pa.int64()] * 6 + [pa.string()] * 2
        names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
        arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
        if with_text:
            run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            arrays += [pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in own] for own in runs], run), collapsed]
            names += ["runs", "collapsed"]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, "text", BATCH_BYTES):
            if batch.num_rows:
                yield work(batch)

    return run


def detect(docs: DataFrame, shaped: bool = False, with_text: bool = True) -> DataFrame:
    """Runs of every text, and the text with one period left of each; digests only without ``with_text``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    columns = _RUNS if with_text else _RUNS[: _RUNS.index(", runs array")]
    return rows.mapInArrow(_detect(shaped, with_text), columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(table(spark, sf_dir, "documents"), shaped=True, with_text=False)


# all periods of all texts are beyond SQL at this size; tests/llm compares with brute force
SQL = None
