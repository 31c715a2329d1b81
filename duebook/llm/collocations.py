"""Collocations: how often the words of a phrase stand together, against how often its halves do.

Every word of a text opens one window of up to ``LONGEST`` words that ends with its piece; the
count of a phrase is the sum over all windows that start with it.

1. A task counts windows in a HAT-trie: a slot of first words leads to a hash container of
   their windows; one that grows beyond ``BURST`` windows bursts into containers for slots of
   second words.  Beyond ``HELD`` windows the largest subtrees leave as sorted runs.
2. A run is cut at the borders of the prefix partitions, which are ranges of (language, words)
   taken from a sample of windows, so a frequent prefix spans as many ranges as it needs.  The
   sample decides who works on a window, never a result.
3. A task merges the runs of a range and sums the windows of each prefix.  A prefix that is no
   prefix of the range's borders is complete; the others may go on in the next range, so those
   partial sums are added up by Spark.  Only phrases of ``least`` occurrences go further.
4. Cuts of candidates meet the counts of their two parts in joins; covering phrases likewise.

Edge cases: a null or empty text has no word; a null language is ``und``; a null ``doc_id`` is
not read; repeated rows count as often as they stand; a text of any length is cut into windows by
the task that reads it; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duebook.llm.shared import batches, table
from duebook.session import materialize

LONGEST = 4
LEAST = 30
TOP = 2000
COVER = 80
# bits of a word id inside a task: words of STEP places and of the trie before them; beyond WORDS the trie starts anew
BITS = 20
WORDS = 250_000
STEP = 1_000_000
# a slot of the trie holds words of this many neighbouring ids, a burst container has a slot for as many second words
SLOT_BITS, FAN_BITS = 3, 6
BURST = 8192
HELD = 500_000
BATCH_BYTES = 4 << 20
# windows that a range is meant to hold
RANGE_WINDOWS = 1_000_000
# the sample behind the borders: documents, and windows of each
SAMPLE_DOCS, SAMPLE_WINDOWS = 2000, 100
# a task ranks at most 2000 phrases from each of these shares of a language
SHARES = 64

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(10 if b in _BREAKS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_MASK = (1 << BITS) - 1
_RUN = "part int, range int, lang string, words binary, n_windows long, windows binary"
_RUN_ARROW = pa.schema(
    [("part", pa.int32()), ("range", pa.int32()), ("lang", pa.string()), ("words", pa.binary()), ("n_windows", pa.int64()), ("windows", pa.binary())]
)
_COUNTS = "lang string, k int, phrase string, f long"


def pieces(texts: list[str | None]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of all texts, the text of each word, and the number of its piece."""
    parts = [(t or "").encode() for t in texts]
    data = b"\n".join(parts).translate(_TABLE)
    raw = np.frombuffer(data, np.uint8)
    gap = (raw == 32) | (raw == 10)
    starts = np.flatnonzero(~gap & np.append(True, gap[:-1])) if len(raw) else np.empty(0, np.int64)
    words = pc.ascii_split_whitespace(pa.array([data.strip(b" \n").decode()], pa.large_string())).flatten()
    if not len(starts):
        words = words.slice(0, 0)
    begins = np.cumsum([0, *[len(p) + 1 for p in parts]][:-1])
    text = np.searchsorted(begins, starts, side="right") - 1
    return words, text, np.cumsum(raw == 10)[starts] if len(raw) else starts


def windows_of(ids: np.ndarray, piece: np.ndarray) -> list[np.ndarray]:
    """For each place the ids of the words from there on, 0 behind the end of the piece."""
    columns = [ids]
    for k in range(1, LONGEST):
        column = np.zeros_like(ids)
        inside = piece[k:] == piece[:-k]
        column[:-k][inside] = ids[k:][inside]
        columns.append(column)
    return columns


class Trie:
    """Counts of windows: a slot of first words of a language leads to a container, or to one for each slot of second words."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.words: list[str] = [""]
        self.langs: dict[str, int] = {}
        self.nodes: dict[int, Counter | list[Counter]] = {}
        self.sizes: dict[int, int] = {}
        self.held = 0

    def word_ids(self, words: list[str]) -> np.ndarray:
        ids, known = self.ids, self.words
        out = np.empty(len(words), np.int64)
        for i, word in enumerate(words):
            found = ids.get(word)
            if found is None:
                found = ids[word] = len(known)
                known.append(word)
            out[i] = found
        return out

    def add(self, lang: np.ndarray, columns: list[np.ndarray]) -> None:
        w1, w2, w3, w4 = columns
        slot = lang << BITS - SLOT_BITS | w1 >> SLOT_BITS
        fan = w2 & (1 << FAN_BITS) - 1
        order = np.argsort(slot << FAN_BITS | fan, kind="stable")
        slot, fan = slot[order], fan[order]
        keys = ((w1 & (1 << SLOT_BITS) - 1) << 3 * BITS | w2 << 2 * BITS | w3 << BITS | w4)[order].tolist()
        new = np.append(True, slot[1:] != slot[:-1])
        bounds = np.append(np.flatnonzero(new), len(slot)).tolist()
        fans = np.flatnonzero(new | np.append(True, fan[1:] != fan[:-1]))
        for a, z in zip(bounds, bounds[1:], strict=False):
            at = int(slot[a])
            node, before = self.nodes.get(at), self.sizes.get(at, 0)
            if node is None:
                node = self.nodes[at] = Counter()
            if isinstance(node, Counter):
                node.update(keys[a:z])
                size = len(node)
                if size > BURST:
                    self.nodes[at] = burst(node)
            else:
                size = before
                cuts = [*fans[np.searchsorted(fans, a) : np.searchsorted(fans, z)].tolist(), z]
                for b, e in zip(cuts, cuts[1:], strict=False):
                    container = node[int(fan[b])]
                    size -= len(container)
                    container.update(keys[b:e])
                    size += len(container)
            self.held += size - before
            self.sizes[at] = size

    def take(self, most: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray] | None:
        """The largest subtrees, until ``most`` windows are left: languages, ids and counts of their windows."""
        keys, counts, slots, sizes = [], [], [], []
        for at in sorted(self.sizes, key=self.sizes.__getitem__, reverse=True):
            if self.held <= most:
                break
            node = self.nodes.pop(at)
            for container in [node] if isinstance(node, Counter) else node:
                keys.append(np.fromiter(container.keys(), np.int64, len(container)))
                counts.append(np.fromiter(container.values(), np.int64, len(container)))
            slots.append(at)
            sizes.append(self.sizes.pop(at))
            self.held -= sizes[-1]
        if not slots:
            return None
        slot, key = np.repeat(np.array(slots, np.int64), sizes), np.concatenate(keys)
        first = (slot & (1 << BITS - SLOT_BITS) - 1) << SLOT_BITS | key >> 3 * BITS
        columns = [first, key >> 2 * BITS & _MASK, key >> BITS & _MASK, key & _MASK]
        return slot >> BITS - SLOT_BITS, columns, np.concatenate(counts)


def burst(container: Counter) -> list[Counter]:
    """One container for each slot of second words."""
    out = [Counter() for _ in range(1 << FAN_BITS)]
    for key, n in container.items():
        out[key >> 2 * BITS & (1 << FAN_BITS) - 1][key] = n
    return out


def _pack(columns: list[np.ndarray], counts: np.ndarray) -> bytes:
    # column by column, which compresses best
    data = np.concatenate([*columns, counts]).astype("<u4")
    wide = (counts >> 32).astype("<u4") if len(counts) and counts.max() >> 32 else np.empty(0, "<u4")
    return pa.compress(data.tobytes() + wide.tobytes(), codec="zstd", asbytes=True)


def _unpack(n: int, data: bytes, size: int) -> tuple[list[np.ndarray], np.ndarray]:
    whole = np.frombuffer(pa.decompress(data, size, codec="zstd", asbytes=True), "<u4")
    counts = whole[LONGEST * n : (LONGEST + 1) * n].astype(np.int64)
    if len(whole) > (LONGEST + 1) * n:
        counts |= whole[(LONGEST + 1) * n :].astype(np.int64) << 32
    return [whole[k * n : (k + 1) * n] for k in range(LONGEST)], counts


class Run:
    """Windows sorted by language and words, as text orders them."""

    def __init__(self, langs: list[str], words: list[str], lang: np.ndarray, columns: list[np.ndarray], counts: np.ndarray):
        by_name = sorted(range(len(langs)), key=langs.__getitem__)
        self.langs = [langs[i] for i in by_name]
        place = np.empty(len(langs), np.int64)
        place[by_name] = np.arange(len(langs))
        used = np.zeros(len(words), bool)
        for column in columns:
            used[column] = True
        used[0] = False
        kept = np.flatnonzero(used)
        names = pa.array([words[i] for i in kept.tolist()], pa.large_string())
        by_word = np.asarray(pc.sort_indices(names))
        rank = np.zeros(len(words), np.int64)
        rank[kept[by_word]] = np.arange(1, len(kept) + 1)
        self.words = ["", *names.take(pa.array(by_word)).to_pylist()]
        lang, ranks = place[lang], [rank[c] for c in columns]
        self.high, self.low = (lang << 2 * BITS) | (ranks[0] << BITS) | ranks[1], ranks[2] << BITS | ranks[3]
        order = np.lexsort((self.low, self.high))
        self.high, self.low, self.counts = self.high[order], self.low[order], counts[order]

    def position(self, border: tuple[str, ...]) -> int:
        """The first window that is not below ``border`` (language, then words; an empty word is the least)."""
        lang = bisect_left(self.langs, border[0])
        values, exact = [lang], lang < len(self.langs) and self.langs[lang] == border[0]
        for word in border[1:]:
            at = bisect_left(self.words, word) if exact else 0
            exact = exact and at < len(self.words) and self.words[at] == word
            values.append(at)
        # a word that is not here stands for the next one, and all words behind it for the least
        high, low = (values[0] << 2 * BITS) | (values[1] << BITS) | values[2], values[3] << BITS | values[4]
        a, z = np.searchsorted(self.high, high), np.searchsorted(self.high, high, side="right")
        return int(a + np.searchsorted(self.low[a:z], low))

    def rows(self, borders: list[tuple[str, ...]], parts: int) -> Iterator[tuple]:
        """One row for each range and language."""
        ends = [*[self.position(b) for b in borders], len(self.high)]
        changes = [int(np.searchsorted(self.high, lang << 2 * BITS)) for lang in range(1, len(self.langs))]
        start = 0
        for k, end in enumerate(ends):
            cuts = [start, *[c for c in changes if start < c < end], end]
            for a, z in zip(cuts, cuts[1:], strict=False):
                if a < z:
                    yield k * parts // len(ends), k, *self._row(a, z)
            start = max(start, end)

    def _row(self, a: int, z: int) -> tuple:
        high, low = self.high[a:z], self.low[a:z]
        columns = [high >> BITS & _MASK, high & _MASK, low >> BITS, low & _MASK]
        used, local = np.unique(np.concatenate([np.zeros(1, np.int64), *columns]), return_inverse=True)
        local = local[1:].reshape(LONGEST, -1)
        words = " ".join([self.words[i] for i in used.tolist()[1:]]).encode()
        packed = pa.compress(words, codec="zstd", asbytes=True)
        return self.langs[int(high[0] >> 2 * BITS)], len(words).to_bytes(8, "little") + packed, z - a, self._sized(list(local), self.counts[a:z])

    @staticmethod
    def _sized(columns: list[np.ndarray], counts: np.ndarray) -> bytes:
        wide = bool(len(counts)) and int(counts.max()) >> 32 > 0
        size = 4 * len(counts) * (LONGEST + 1 + wide)
        return size.to_bytes(8, "little") + _pack(columns, counts)


def _count(borders: list[tuple[str, ...]], parts: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie()

        def spill(most: int) -> Iterator[pa.RecordBatch]:
            taken = trie.take(most)
            if taken is not None:
                out = [*Run(list(trie.langs), trie.words, *taken).rows(borders, parts)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _RUN_ARROW, strict=True)], schema=_RUN_ARROW)

        for batch in batches(rows, "text", BATCH_BYTES):
            langs = batch.column(0).to_pylist()
            words, text, piece = pieces(batch.column(1).to_pylist())
            for a in range(0, len(words), STEP):
                z = min(a + STEP, len(words))
                # the last windows of a step reach into the next one
                coded = words.slice(a, z - a + LONGEST - 1).dictionary_encode()
                if len(trie.words) + len(coded.dictionary) > WORDS:
                    yield from spill(0)
                    trie.clear()
                ids = trie.word_ids(coded.dictionary.to_pylist())[np.asarray(coded.indices)]
                lang = np.array([trie.langs.setdefault(v, len(trie.langs)) for v in langs], np.int64)
                columns = windows_of(ids, piece[a : z + LONGEST - 1])
                trie.add(lang[text[a:z]], [c[: z - a] for c in columns])
                if trie.held > HELD:
                    yield from spill(HELD // 2)
        yield from spill(0)

    return run


def words_of(text: bytes) -> pa.Array:
    """The words of a run, which single spaces separate."""
    return pc.split_pattern(pa.array([text.decode()], pa.large_string()), " ").flatten()


def merge(runs: list[tuple[pa.Array, list[np.ndarray], np.ndarray]], least: int, ends: set[tuple[str, ...]]) -> Iterator[tuple[int, str, int]]:
    """(k, phrase, count) of the phrases in sorted runs of one range: those of ``least``, and all of ``ends``."""
    coded = pa.concat_arrays([words for words, _, _ in runs]).dictionary_encode()
    words, ranks = coded.dictionary, np.asarray(coded.indices).astype(np.uint64) + np.uint64(1)
    high, low, at = [], [], 0
    for own, columns, _ in runs:
        rank = np.append(np.uint64(0), ranks[at : at + len(own)])
        at += len(own)
        c = [rank[column] for column in columns]
        # two numbers of 32 bits share a key
        high.append(c[0] << np.uint64(32) | c[1])
        low.append(c[2] << np.uint64(32) | c[3])
    high, low = np.concatenate(high), np.concatenate(low)
    counts = np.concatenate([n for _, _, n in runs])
    order = np.lexsort((low, high))
    high, low, counts = high[order], low[order], counts[order]
    yield 0, "", int(counts.sum())
    half = np.uint64(32)
    # numbers of the words at the ends of the range; an unknown one is 0, which is no word
    known = {w: int(n) + 1 for w in {w for end in ends for w in end} if (n := pc.index(words, pa.scalar(w, words.type)).as_py()) >= 0}
    border = {tuple(known.get(w, 0) for w in end) for end in ends}
    for k in range(1, LONGEST + 1):
        new = np.ones(len(high), bool)
        own = high >> half if k == 1 else high
        new[1:] = own[1:] != own[:-1]
        if k > 2:
            own = low >> half if k == 3 else low
            new[1:] |= own[1:] != own[:-1]
        firsts = np.flatnonzero(new)
        sums = np.add.reduceat(counts, firsts)
        columns = [(high[firsts] >> half), high[firsts] & np.uint64(0xFFFFFFFF), low[firsts] >> half, low[firsts] & np.uint64(0xFFFFFFFF)][:k]
        kept = sums >= least
        for end in border:
            if len(end) == k and 0 not in end:
                kept |= np.logical_and.reduce([column == np.uint64(w) for column, w in zip(columns, end, strict=True)])
        kept &= columns[-1] > 0
        names = [words.take(pa.array(column[kept] - np.uint64(1))).to_pylist() for column in columns]
        for parts, n in zip(zip(*names, strict=True), sums[kept].tolist(), strict=True):
            yield k, " ".join(parts), n


def ends_of(borders: list[tuple[str, ...]], number: int, lang: str) -> set[tuple[str, ...]]:
    """Phrases of ``lang`` that may have windows in range ``number`` and in others."""
    return {b[1 : k + 1] for b in borders[max(0, number - 1) : number + 1] if b[0] == lang for k in range(1, LONGEST + 1) if b[k]}


def _merge(least: int, borders: list[tuple[str, ...]]):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, runs, out = None, [], []

        def flush() -> pa.RecordBatch:
            types = [pa.string(), pa.int32(), pa.string(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["lang", "k", "phrase", "f"])

        for batch in rows:
            for number, lang, words, n, data in zip(*[batch.column(i).to_pylist() for i in range(1, 6)], strict=True):
                if at is not None and (number, lang) != at:
                    out.extend((at[1], *row) for row in merge(runs, least, ends_of(borders, *at)))
                    runs = []
                    if len(out) > 50_000:
                        yield flush()
                at = (number, lang)
                names = pa.decompress(words[8:], int.from_bytes(words[:8], "little"), codec="zstd", asbytes=True)
                columns, counts = _unpack(n, data[8:], int.from_bytes(data[:8], "little"))
                runs.append((words_of(names), columns, counts))
        if at is not None:
            out.extend((at[1], *row) for row in merge(runs, least, ends_of(borders, *at)))
        if out:
            yield flush()

    return run


def _sampled(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some windows of each text, evenly spaced, and its number of words."""
    names = ["lang", "n", *[f"w{k}" for k in range(LONGEST)]]
    for batch in batches(rows, "text", BATCH_BYTES):
        for lang, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words, _, piece = pieces([value])
            if n := len(words):
                step = max(1, n // SAMPLE_WINDOWS)
                columns = [c[step // 2 :: step] for c in windows_of(np.arange(1, n + 1), piece)]
                known = pa.concat_arrays([pa.array([""], pa.large_string()), words])
                texts = [known.take(pa.array(c)).cast(pa.string()) for c in columns]
                size = len(columns[0])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * size, pa.string()), pa.array(np.full(size, n / size)), *texts], names=names)


def borders_of(docs: DataFrame) -> list[tuple[str, ...]]:
    """Ascending (language, words) that cut the windows into ranges of about equal size."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = docs.count()
    if not total:
        return []
    share = min(1.0, SAMPLE_DOCS / total)
    columns = "lang string, n double, " + ", ".join(f"w{k} string" for k in range(LONGEST))
    found = docs.sample(False, share, seed=13).mapInArrow(_sampled, columns).collect()
    weighed = sorted((tuple(r[0:1]) + tuple(r[2:]), r[1]) for r in found)
    if not weighed:
        return []
    sums = np.cumsum([n for _, n in weighed])
    ranges = max(parts, int(sums[-1] / share / RANGE_WINDOWS) + 1)
    cuts = np.searchsorted(sums, sums[-1] * np.arange(1, ranges) / ranges)
    return sorted({weighed[min(int(c), len(weighed) - 1)][0] for c in cuts})


def phrase_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, k, phrase, f) of all phrases of k words with ``least`` occurrences; k = 0 holds all words of a language."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    borders = borders_of(rows)
    runs = rows.mapInArrow(_count(borders, parts), _RUN)
    merged = runs.repartitionById(parts, F.col("part")).sortWithinPartitions("range", "lang").mapInArrow(_merge(least, borders), _COUNTS)
    summed = merged.groupBy("lang", "k", "phrase").agg(F.sum("f").alias("f"))
    return materialize(summed.filter((F.col("f") >= least) | (F.col("k") == 0)))


def _part(start, length):
    return F.array_join(F.slice("parts", start, length), " ")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language with their counts and scores."""
    counts = phrase_counts(docs, least)
    phrases = counts.filter("k > 0").select("lang", "phrase", "f")
    candidates = counts.filter("k > 1").select("lang", "k", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("parts"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut", _part(F.lit(1), F.col("cut")).alias("head"), _part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("tail")
    )
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = phrases.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    # a decimal keeps the product exact where a long would overflow
    score = F.expr("(cast(a as decimal(38, 0)) * 2000000) div (l + r)")
    scored = (
        cuts.join(heads, ["lang", "head"])
        .join(tails, ["lang", "tail"])
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))
    )
    # phrases inside longer ones: each start, each length from two words on
    inside = (
        candidates.filter("k > 2")
        .select("lang", "k", "a", "parts", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("start"))
        .select("*", F.explode(F.sequence(F.lit(2), F.least(F.col("k") - 1, F.greatest(F.lit(2), F.col("k") - F.col("start") + 1)))).alias("size"))
        .select("lang", "a", _part(F.col("start"), F.col("size")).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    left = (
        scored.join(inside, ["lang", "phrase"], "left")
        .filter(F.col("longer").isNull() | (F.col("longer").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * COVER))
        .select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    few = left.select("*", share.alias("share")).select("*", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order)).alias("own")).filter(F.col("own") <= top)
    ranked = few.select("*", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long").alias("rank")).filter(F.col("rank") <= top)
    totals = counts.filter("k = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


SQL = r"""
with split as (
  select row_number() over () as row_id, coalesce(lang, 'und') as lang,
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') as pieces
  from documents
), piece as (
  select lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') as words from split
), opened as (
  select lang, words, unnest(range(1, len(words) + 1)) as i from piece
), counted as (
  select lang, k, array_to_string(words[i : i + k - 1], ' ') as phrase, count(*) as f
  from opened, (select unnest([1, 2, 3, 4]) as k) where i + k - 1 <= len(words) group by all
), total as (
  select lang, sum(f)::bigint as n from counted where k = 1 group by lang
), frequent as (
  select *, string_split(phrase, ' ') as parts from counted where f >= 30
), cut as (
  select lang, phrase, f as a, c, array_to_string(parts[1 : c], ' ') as head, array_to_string(parts[c + 1 : k], ' ') as tail
  from frequent, (select unnest([1, 2, 3]) as c) where k > 1 and c < k
), scored as (
  select cut.lang, cut.phrase, a, h.f as l, t.f as r, c, ((2000000 * a::hugeint) // (h.f + t.f))::bigint as score
  from cut join frequent h on cut.lang = h.lang and cut.head = h.phrase join frequent t on cut.lang = t.lang and cut.tail = t.phrase
), lowest as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, c) = 1
), inside as (
  select lang, array_to_string(parts[s : s + m - 1], ' ') as phrase, max(f) as longer
  from frequent, (select unnest([1, 2, 3]) as s), (select unnest([2, 3]) as m)
  where k > 2 and m < k and s + m - 1 <= k group by all
), kept as (
  select lowest.* from lowest left join inside using (lang, phrase)
  where longer is null or 100 * longer::hugeint < 80 * a::hugeint
)
select kept.lang, row_number() over (partition by kept.lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from kept join total using (lang)
qualify rank <= 2000
"""
