"""Benchmark decontamination with suffix arrays over shards of the training words.

Every Arrow batch of documents is cut into shards of bounded size.  A shard's words become
numbers of the test vocabulary (0: not in any test item).  Only stretches whose every q-gram
occurs in a test item can hold a match, so the suffix array is built over those stretches by
prefix doubling; it is exact for all matches of at least q words, and q never exceeds the
shortest window.  Every test suffix of the shard is then looked up by binary search, which
gives the range of training suffixes that start with its window (the occurrences).  For the
longest verbatim match of each document, every place of its stretches is looked up in the suffix
array of the test words; of equally long matches the first in the document is reported, with the
smallest id of the items that hold it.

The test words travel to the executors in blocks of at most ``BLOCK_CHARS`` characters; a
larger benchmark takes more passes over the documents, none of its items is left out.

Edge cases: a null or empty text has no words; an item without words has no window; an item
with a null id marks words but is not listed; repeated items and rows are all reported; extra
columns are kept.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.llm.shared import ALNUM_WORDS, lower_ascii, release_memory, table

WINDOW = 10
BLOCK_CHARS = 8_000_000
SHARD_BYTES = 16_000_000
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_FOUND = "n_words long, hits array<int>, items array<long>, longest int, longest_start int, longest_item long"


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words of letters, digits and code points above ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(ALNUM_WORDS).split() if text else []


class TestWords:
    """The words of some test items, their windows and their q-grams."""

    __test__ = False

    def __init__(self, items: list[tuple[int | None, str | None]], window: int = WINDOW, q: int | None = None):
        texts = [(item_id, words_of(text)) for item_id, text in items]
        texts = [(item_id, words) for item_id, words in texts if words]
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary
        for _, words in texts:
            for word in words:
                number.setdefault(word, len(number) + 1)
        self.items = [(item_id, np.array([number[w] for w in words], np.int64)) for item_id, words in texts]
        self.window = window
        self.q = q or min([min(len(a), window) for _, a in self.items], default=window)
        # windows by content: the items that hold each
        self.windows: dict[bytes, tuple[np.ndarray, set[int]]] = {}
        grams = set()
        for item_id, a in self.items:
            n = min(window, len(a))
            for i in range(len(a) - n + 1):
                part = a[i : i + n]
                self.windows.setdefault(part.tobytes(), (part, set()))[1].add(item_id)
            for i in range(len(a) - self.q + 1):
                grams.add(int(self._mix(a[i : i + self.q])))
        self.grams = np.array(sorted(grams), np.uint64)
        # all items in one sequence, a 0 after each; big-endian, so that bytes compare like numbers
        ids = np.concatenate([np.zeros(0, np.int64), *[np.append(a, 0) for _, a in self.items]])
        self.sequence = ids.astype(">u4").tobytes()
        self.order = suffix_array(ids) if len(ids) else ids
        # the item of each suffix; those without an id come last
        known = sorted({item_id for item_id, _ in self.items if item_id is not None})
        rank = {item_id: k for k, item_id in enumerate(known)}
        of_item = np.array([rank.get(item_id, len(known)) for item_id, _ in self.items], np.int64)
        owner = np.repeat(of_item, [len(a) + 1 for _, a in self.items])
        self.owner, self.item_ids = owner[self.order], [*known, None]

    def ids_of(self, words: list[bytes]) -> np.ndarray:
        """Numbers of words; 0 for one that no test item has."""
        number = self.vocabulary.get
        return np.array([number(w, 0) for w in words], np.int32)

    def _find(self, part: bytes) -> int:
        """Number of the suffixes before ``part`` in their order."""
        size, data = len(part), self.sequence
        return bisect_left(self.order, part, key=lambda at: data[4 * int(at) : 4 * int(at) + size])

    def _holds(self, part: bytes, low: int) -> bool:
        at = 4 * int(self.order[low]) if low < len(self.order) else len(self.sequence)
        return self.sequence[at : at + len(part)] == part

    def longest(self, ids: np.ndarray) -> tuple[int, int, int | None] | None:
        """Longest match of at least q words in ``ids``: (words, first place, item)."""
        data, n = ids.astype(">u4").tobytes(), len(ids)
        known = ids > 0
        # the end of the run of known words that each place lies in
        ends = np.where(known, n, np.arange(n))
        ends = np.minimum.accumulate(ends[::-1])[::-1] if n else ends
        best, place = self.q - 1, -1
        for i in np.flatnonzero(known).tolist():
            end = int(ends[i])
            # only a longer match than the best counts
            if end - i <= best or not self._holds(part := data[4 * i : 4 * (i + best + 1)], self._find(part)):
                continue
            low, high, step = best + 1, end - i, 1
            while low < high:
                size = min(low + step, high)
                part = data[4 * i : 4 * (i + size)]
                if self._holds(part, self._find(part)):
                    low, step = size, step * 2
                elif step > 1:
                    high, step = size - 1, 1
                else:
                    break
            best, place = low, i
        if place < 0:
            return None
        part = data[4 * place : 4 * (place + best)]
        low = self._find(part)
        high = self._find(part + b"\xff\xff\xff\xff")
        return best, place, self.item_ids[int(self.owner[low:high].min())]

    @staticmethod
    def _mix(part: np.ndarray) -> np.uint64:
        with np.errstate(over="ignore"):
            h = np.uint64(0)
            for x in part.astype(np.uint64):
                h = h * np.uint64(0x9E3779B97F4A7C15) + x
            return h

    def stretches(self, ids: np.ndarray) -> np.ndarray:
        """True for each word that lies in a q-gram whose hash a test q-gram has."""
        covered = np.zeros(len(ids), bool)
        n = len(ids) - self.q + 1
        if n < 1 or not len(self.grams):
            return covered
        # only where q known words follow each other
        known = np.concatenate((np.zeros(1, np.int32), np.cumsum(ids > 0, dtype=np.int32)))
        begin = np.flatnonzero(known[self.q :] - known[: -self.q] == self.q)
        with np.errstate(over="ignore"):
            h = np.zeros(len(begin), np.uint64)
            for j in range(self.q):
                h *= np.uint64(0x9E3779B97F4A7C15)
                h += ids[begin + j].astype(np.uint64)
        place = np.minimum(np.searchsorted(self.grams, h), len(self.grams) - 1)
        begin = begin[self.grams[place] == h]
        step = np.zeros(len(ids) + 1, np.int32)
        np.add.at(step, begin, 1)
        np.add.at(step, begin + self.q, -1)
        return np.cumsum(step[:-1], dtype=np.int32) > 0


def suffix_array(ids: np.ndarray) -> np.ndarray:
    """Positions in the order of the suffixes of ``ids``, by prefix doubling."""
    n = len(ids)
    _, rank = np.unique(ids, return_inverse=True)
    rank, step = rank.astype(np.int64), 1
    while True:
        second = np.full(n, -1, np.int64)
        second[: n - step] = rank[step:] if step < n else second[:0]
        both = rank * (n + 1) + second + 1
        order = np.argsort(both, kind="stable")
        ordered = both[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank = new
        step *= 2
        if step >= n or rank[order[-1]] == n - 1:
            return order


def _narrow(ids: np.ndarray, order: np.ndarray, low: int, high: int, depth: int, word: int) -> tuple[int, int]:
    """Of the suffixes in order[low:high], equal up to ``depth``, those that go on with ``word``."""
    n = len(ids)

    def bound(after: bool) -> int:
        a, b = low, high
        while a < b:
            middle = (a + b) // 2
            at = order[middle] + depth
            here = ids[at] if at < n else -1
            if here < word or (after and here == word):
                a = middle + 1
            else:
                b = middle
        return a

    return bound(False), bound(True)


def search_shard(test: TestWords, texts: list[list[bytes]]) -> list[tuple]:
    """For each document (n_words, hit positions, items, longest match, its place, its item)."""
    return search_ids(test, [test.ids_of(words) for words in texts])


def search_ids(test: TestWords, texts: list[np.ndarray]) -> list[tuple]:
    """``search_shard`` for documents whose words are numbers already, four bytes each."""
    sizes = np.array([len(w) for w in texts], np.int64)
    # one 0 after each document keeps matches inside it
    ids = np.zeros(int(sizes.sum()) + len(texts), np.int32)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    for start, words in zip(starts, texts, strict=True):
        ids[start : start + len(words)] = words
    covered = test.stretches(ids)
    found: list[tuple] = [(int(n), [], set(), 0, None, None) for n in sizes]
    if not covered.any():
        return found
    # what lies outside the stretches shrinks to one separator each
    keep = covered.copy()
    keep[1:] |= covered[:-1]
    place = np.flatnonzero(keep)
    short = np.where(covered[place], ids[place], 0)
    order = suffix_array(short)
    present = set(np.unique(short).tolist())
    hit = np.zeros(len(ids) + 1, np.int32)
    items: dict[int, set[int]] = {}
    for part, owners in test.windows.values():
        if not present.issuperset(part.tolist()):
            continue
        low, high = 0, len(order)
        for depth, word in enumerate(part.tolist()):
            low, high = _narrow(short, order, low, high, depth, word)
            if low == high:
                break
        if low < high:
            at = place[order[low:high]]
            np.add.at(hit, at, 1)
            np.add.at(hit, at + len(part), -1)
            for doc in np.unique(np.searchsorted(starts, at, side="right") - 1).tolist():
                items.setdefault(doc, set()).update(owners)
    marked = np.cumsum(hit[:-1], dtype=np.int32) > 0
    covered_docs = np.unique(np.searchsorted(starts, np.flatnonzero(covered), side="right") - 1)
    for doc in covered_docs.tolist():
        here = slice(starts[doc], starts[doc] + sizes[doc])
        own = np.flatnonzero(marked[here])
        longest = test.longest(np.where(covered[here], ids[here], 0))
        found[doc] = (int(sizes[doc]), own.tolist(), items.get(doc, set()) - {None}, *(longest or (0, None, None)))
    return found


def _searcher(broadcast, window: int, q: int | None) -> Callable:
    def found(test: TestWords, texts: pd.Series) -> pd.DataFrame:
        rows: list[tuple] = []
        shard: list[np.ndarray] = []
        size = 0
        for text in texts:
            shard.append(test.ids_of(words_of(text)))
            size += len(text) if text else 0
            if size >= SHARD_BYTES:
                rows.extend(search_ids(test, shard))
                shard, size = [], 0
        rows.extend(search_ids(test, shard) if shard else [])
        rows = [(n, hits, sorted(items), long, at, item) for n, hits, items, long, at, item in rows]
        names = ["n_words", "hits", "items", "longest", "longest_start", "longest_item"]
        return pd.DataFrame({name: pd.Series([r[i] for r in rows], dtype=object) for i, name in enumerate(names)})

    @F.pandas_udf(_FOUND)
    def search(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        test = _test_words(broadcast, window, q)
        for texts in parts:
            yield found(test, texts)
        release_memory()

    return search


_PREPARED: list[tuple] = []


def _test_words(broadcast, window: int, q: int | None) -> TestWords:
    """Prepared once in each Python worker."""
    items = broadcast.value
    if not _PREPARED or _PREPARED[0][0] is not items or _PREPARED[0][1] != (window, q):
        _PREPARED[:] = [(items, (window, q), TestWords(items, window, q))]
    return _PREPARED[0][2]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Each row of ``docs`` as a struct ``doc``, with n_words, n_hit, items and its longest match.

    The longest match has at least as many words as the shortest item, or ``window``.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    n_words = F.size(F.array_remove(F.split(lower_ascii(F.coalesce("text", F.lit(""))), GAP), ""))
    shortest = F.min(F.when(n_words > 0, F.least(n_words, F.lit(window))))
    chars, q = items.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0)), shortest).first()
    n_blocks = max(1, -(-chars // block_chars))
    block = F.pmod(F.xxhash64("text", "item_id"), F.lit(n_blocks))
    found = docs.select(F.struct("*").alias("doc"))
    for k in range(n_blocks):
        rows = [tuple(r) for r in items.filter(block == k).collect()]
        search = _searcher(spark.sparkContext.broadcast(rows), window, q)
        found = found.withColumn(f"found{k}", search("doc.text"))
    blocks = [F.col(f"found{k}") for k in range(n_blocks)]
    matches = [
        F.struct((-b.longest).alias("order"), b.longest_start.alias("start"), b.longest_item.isNull().alias("no_id"), b.longest_item.alias("item"))
        for b in blocks
    ]
    best = F.array_min(F.array(*matches))
    return found.select(
        "doc",
        blocks[0].n_words.alias("n_words"),
        F.size(F.array_distinct(F.flatten(F.array(*[b.hits for b in blocks])))).cast("long").alias("n_hit"),
        F.array_distinct(F.flatten(F.array(*[b["items"] for b in blocks]))).alias("items"),
        F.struct((-best["order"]).alias("longest"), best["start"].alias("start"), best["item"].alias("item")).alias("longest"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def items_digest(items: list[int]) -> str:
    """The digest of ``query`` for a list of ids."""
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


SQL = r"""
with doc_words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents
), item_words as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from benchmark
), windows as (
  select distinct item_id, least(10, len(words)) as n, array_to_string(words[i : i + least(10, len(words)) - 1], ' ') as part
  from (select item_id, words, unnest(range(1, len(words) - least(10, len(words)) + 2)) as i from item_words where len(words) > 0)
), doc_parts as (
  select d.doc_id, d.i, s.n, array_to_string(d.words[d.i : d.i + s.n - 1], ' ') as part
  from (select doc_id, words, unnest(range(1, len(words) + 1)) as i from doc_words) d
  join (select distinct n from windows) s on d.i + s.n - 1 <= len(d.words)
), places as (
  select p.doc_id, p.i, p.n, w.item_id from doc_parts p join windows w on p.n = w.n and p.part = w.part
), hits as (
  select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + n)) as j from places) group by doc_id
), found as (
  select doc_id, count(distinct item_id) as n_items,
    string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids
  from places group by doc_id
)
select d.doc_id, len(d.words)::bigint as n_words, coalesce(h.n_hit, 0) as n_hit, coalesce(f.n_items, 0) as n_items,
  sha256(coalesce(f.ids, '')) as items_sha256, coalesce(h.n_hit, 0) > 0 as contaminated
from doc_words d left join hits h using (doc_id) left join found f using (doc_id)
"""
