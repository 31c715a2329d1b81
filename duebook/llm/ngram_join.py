"""Exact Jaccard self-join of word shingles with adaptive multi-match prefixes.

1. One pass over the texts gives each document's set size and a 128-bit class of its set (equal
   sets are one class from here on), and a frequency sketch of all shingles: ``1 << SKETCH_BITS``
   counters, whatever the corpus.  Shingles are ordered by the sketch's level, rare ones
   first, and by hash within a level; every document uses the same order.
2. A set that shares ``l`` shingles must do so within the first ``n - ceil(t n) + l`` shingles of
   both sets.  Each document takes the ``l`` among 1 to ``MAX_MATCHES`` times ``n // SHARE + 1`` for
   which its estimated cost, list entries read plus candidates compared over whole sets, is least,
   and posts that prefix: the shortest one where its shingles are rare, a longer one where the
   sketch shows more occurrences than a counter has by chance.
3. Postings are grouped by shingle and sorted by set size; a group is cut where the next size is
   too large for the one before.  The first class of a stretch is its pivot; the others
   join the pivot's group.  Groups grow with the postings, not with their pairs.  A class
   with fewer shared postings than its least ``l`` asks for has no partner and leaves.
4. Inside its groups a class brings its prefix first: candidates share ``min(l_a, l_b)`` of its
   shingles and pass the length filter.  Classes without a candidate go no further.
   Texts are exchanged for this only if a filter of fixed size (``FILTER_BITS``) may hold them; what it
   lets through by mistake leaves in the join.
5. The others come with their whole sets, and each pair is verified in one of its groups only.
   A large group is cut into blocks whose pairs are separate tasks' work.  A group
   returns a spanning forest of its links and link counts, never all its pairs.
6. Components come from alternating large and small stars over the forest edges.

Shingles are compared by 64-bit hashes.

Edge cases: a null or empty text has an empty set and is linked with nothing; a text of fewer
words than a shingle is one shingle; repeated rows are linked copies; a null ``doc_id`` belongs to a
component but never names it; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.llm.shared import SPACED_WORDS, release_memory, releasing, table
from duebook.session import discard, materialize

WORDS = 4
PERCENT = 85
SKETCH_BITS = 18
CHUNK = 4096
SHARE = 32
MAX_MATCHES = 3
# bits of the filter that keeps texts without a partner out of the second exchange, whatever the corpus
FILTER_BITS = 27
BLOCK_SHINGLES = 1_000_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 2**64))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    if len(_POWERS[0]) < n:
        size = max(n, 2 * len(_POWERS[0]), 1 << 16)
        for i, base in enumerate((_ODD, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text."""
    if not text:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(SPACED_WORDS), np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = data != 32
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    n = len(starts)
    if not n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        up, down = _powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(data * up[:-1], out=sums[1:])
        hashes = _mix((sums[ends] - sums[starts]) * down[starts])
        size = min(words, n)
        out = np.full(n - size + 1, size, np.uint64)
        for i in range(size):
            out = _mix(out * _ODD + hashes[i : i + n - size + 1])
    return np.unique(out)


def set_class(found: np.ndarray) -> bytes:
    """128 bits that stand for a set, its size included; the first 64 are its number."""
    with np.errstate(over="ignore"):
        one = _mix(found + np.uint64(len(found))).sum(dtype=np.uint64)
        two = _mix(found * _ODD + np.uint64(1)).sum(dtype=np.uint64)
    return np.array([one, two], np.uint64).tobytes()


class Order:
    """The global order of shingles and the adaptive prefixes, from the sketch."""

    def __init__(self, sketch: np.ndarray, percent: int):
        mean = max(1.0, float(sketch.mean()))
        self.level = np.floor(np.log2(np.maximum(sketch / mean, 1.0))).astype(np.int8)
        # a counter is shared by rare shingles, whose number varies by the root of its mean
        self.expected = np.maximum(sketch - mean - 4 * np.sqrt(mean), 0.0)
        self.mask = np.uint64(len(sketch) - 1)
        self.percent = percent

    def arrange(self, found: np.ndarray) -> tuple[np.ndarray, int, int]:
        """(shingles in global order, required matches l, prefix length)."""
        n = len(found)
        bucket = (found & self.mask).astype(np.int64)
        level = self.level[bucket]
        if level.any():
            order = np.lexsort((found, level))
            found, bucket = found[order], bucket[order]
        needed = -(-self.percent * n // 100)
        base = n - needed
        read = np.cumsum(self.expected[bucket])
        best, matches = None, 1
        for times in range(1, MAX_MATCHES + 1):
            m = min(needed, times * (n // SHARE + 1))
            # list entries read, and candidates, each of which is compared over a whole set
            cost = read[base + m - 1] * (1 + n / m)
            if best is None or cost < best:
                best, matches = cost, m
        return found, matches, base + matches


_PROFILE = "doc_id long, text_hash long, class binary, number long, n long, chunk int, counts binary"
_PROFILE_ARROW = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]


def _numbers(classes: list[bytes | None]) -> pa.Array:
    """The first half of each class: short for the many postings; classes of one number come apart where their sets are read."""
    return pa.array([None if c is None else int.from_bytes(c[:8], "little", signed=True) for c in classes], pa.int64())


def _profile(words: int):
    """Class and size of each set, then the task's share of the sketch."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        names = ["doc_id", "text_hash", "class", "number", "n", "chunk", "counts"]
        for batch in rows:
            classes, sizes = [], []
            for text in batch.column(2):
                found = shingles(text.as_py(), words)
                sizes.append(len(found))
                classes.append(set_class(found) if len(found) else None)
                np.add.at(sketch, (found & np.uint64(len(sketch) - 1)).astype(np.int64), 1)
            n = batch.num_rows
            columns = [batch.column(0), batch.column(1), pa.array(classes, pa.binary()), _numbers(classes), pa.array(sizes, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        if sketch.any():
            parts = sketch.reshape(-1, CHUNK)
            n = len(parts)
            columns = [pa.nulls(n, t) for t in _PROFILE_ARROW[:5]] + [pa.array(range(n), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _add_chunks(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in rows:
        for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sums[chunk] = sums.get(chunk, 0) + np.frombuffer(counts, np.int64)
    if sums:
        columns = [pa.array(sums.keys(), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["chunk", "counts"])


def _sketch(profiles: DataFrame) -> np.ndarray:
    parts = profiles.filter(F.col("chunk").isNotNull()).select("chunk", "counts").repartition("chunk").mapInArrow(_add_chunks, "chunk int, counts binary")
    sketch = np.zeros((1 << SKETCH_BITS) // CHUNK * CHUNK, np.int64).reshape(-1, CHUNK)
    for row in parts.collect():
        sketch[row["chunk"]] += np.frombuffer(row["counts"], np.int64)
    return sketch.reshape(-1)


def _postings(order, words: int):
    """(shingle, number, n) for the prefix of every set."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrange = order.value.arrange
        for batch in rows:
            tokens, sizes, classes, filled = [], [], [], 0

            def made() -> pa.RecordBatch:
                counts = [len(t) for t in tokens]
                flat = np.concatenate(tokens).view(np.int64)
                owner = pa.array(np.repeat(np.arange(len(classes)), counts))
                columns = [pa.array(flat), _numbers(classes).take(owner), pa.array(np.repeat(np.array(sizes, np.int32), counts))]
                return pa.RecordBatch.from_arrays(columns, names=["token", "number", "n"])

            for text in batch.column(0):
                found = shingles(text.as_py(), words)
                if not len(found):
                    continue
                ordered, _, length = arrange(found)
                tokens.append(ordered[:length])
                sizes.append(len(found))
                classes.append(set_class(found))
                filled += length
                if filled > 200_000:
                    yield made()
                    tokens, sizes, classes, filled = [], [], [], 0
            if tokens:
                yield made()

    return run


def _pivots(percent: int):
    """Rows sorted by shingle, size and class: the first class of a stretch is the pivot of all."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, pivot, last, size, written = None, None, None, 0, False
        for batch in rows:
            tokens = np.asarray(batch.column(0))
            same = tokens[1:] == tokens[:-1]
            # a shingle that stands alone needs no look, but for the ends of the batch
            look = np.ones(len(tokens), bool)
            look[1:-1] = same[:-1] | same[1:]
            at = np.flatnonzero(look)
            part = batch.take(pa.array(at))
            out: list[tuple] = []
            for t, c, n in zip(tokens[at].tolist(), part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                if t != token or 100 * size < percent * n:
                    token, pivot, last, written = t, (c, n), c, False
                elif c != last:
                    if not written:
                        out.append((pivot[0], *pivot))
                        written = True
                    out.append((pivot[0], c, n))
                    last = c
                size = n
            if out:
                columns = [pa.array(v, k) for v, k in zip(zip(*out, strict=True), [pa.int64(), pa.int64(), pa.int32()], strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["pivot", "number", "n"])

    return run


_SETS = "class binary, copies long, groups array<struct<pivot:long,blocks:int>>, n int, matches int, front binary, rest binary"


def _sets(order, words: int):
    """Size, prefix and rest of the set of each candidate class."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrange = order.value.arrange
        for batch in rows:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                made = [arrange(shingles(text.as_py(), words)) for text in part.column(0)]
                columns = [part.column(1), part.column(2), part.column(3)]
                columns += [pa.array([len(m[0]) for m in made], pa.int32()), pa.array([m[1] for m in made], pa.int32())]
                columns += [pa.array([m[0][: m[2]].tobytes() for m in made], pa.binary()), pa.array([m[0][m[2] :].tobytes() for m in made], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["class", "copies", "groups", "n", "matches", "front", "rest"])

    return run


def _placed(sets: DataFrame) -> DataFrame:
    """Each prefix once for every block pair of each of its groups."""
    own = F.pmod(F.xxhash64("class"), F.col("group.blocks")).cast("int")
    pivots = F.array_sort(F.transform("groups", lambda g: g["pivot"])).alias("pivots")
    rows = sets.select("class", "n", "matches", "front", pivots, F.explode("groups").alias("group")).withColumn("block", own)
    return rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("group.blocks") - 1))).select(
        F.col("group.pivot").alias("pivot"),
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "class",
        "block",
        "n",
        "matches",
        "pivots",
        "front",
    )


def _shared(lists: list[np.ndarray], wanted: np.ndarray | None = None):
    """For lists of distinct values, a function a -> how many values each list shares with list a."""
    sizes = np.array([len(x) for x in lists], np.int64)
    flat = np.concatenate(lists) if len(lists) else np.zeros(0, np.uint64)
    values, dense = np.unique(flat, return_inverse=True)
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    owner = np.repeat(np.arange(len(lists)), sizes)
    by_value = owner[np.argsort(dense, kind="stable")]
    starts = np.concatenate(([0], np.cumsum(np.bincount(dense, minlength=len(values)))))

    def counts(a: int) -> np.ndarray:
        own = dense[bounds[a] : bounds[a + 1]]
        parts = [by_value[starts[v] : starts[v + 1]] for v in own.tolist() if starts[v + 1] - starts[v] > 1]
        return np.bincount(np.concatenate(parts), minlength=len(lists)) if parts else np.zeros(len(lists), np.int64)

    return counts


def candidates(pivot: int, crossed: bool, members: list[tuple], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(a, others) of the pairs that this group has to verify.

    A member is (class, block, n, matches, pivots, front, ...).  ``crossed``: only pairs of
    different blocks.  Pairs that share an earlier pivot are verified there.
    """
    blocks, sizes, matches = (np.array([x[i] for x in members], np.int64) for i in (1, 2, 3))
    names: dict[int, int] = {}
    earlier = [np.array([names.setdefault(p, len(names)) for p in x[4] if p < pivot], np.uint64) for x in members]
    common_front = _shared([x[5] for x in members])
    common_earlier = _shared(earlier) if names else None
    index = np.arange(len(members))
    for a in range(len(members) - 1):
        possible = (index > a) & (100 * np.minimum(sizes, sizes[a]) >= percent * np.maximum(sizes, sizes[a]))
        if crossed:
            possible &= blocks != blocks[a]
        if not possible.any():
            continue
        possible &= common_front(a) >= np.minimum(matches, matches[a])
        if common_earlier is not None and possible.any():
            possible &= common_earlier(a) == 0
        others = np.flatnonzero(possible)
        if len(others):
            yield a, others


def compare(pivot: int, crossed: bool, members: list[tuple], percent: int) -> tuple[dict[int, int], list[tuple[int, int]]]:
    """Link counts and a spanning forest of the links; members end with (..., rest, copies)."""
    links: dict[int, int] = {}
    forest: list[tuple[int, int]] = []
    parent = list(range(len(members)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    whole = [np.sort(np.concatenate([x[5], x[6]])) for x in members]
    sizes = np.array([len(x) for x in whole], np.int64)
    for a, others in candidates(pivot, crossed, members, percent):
        own = whole[a]
        flat = np.concatenate([whole[b] for b in others])
        place = np.minimum(np.searchsorted(own, flat), len(own) - 1)
        bounds = np.concatenate(([0], np.cumsum(sizes[others])))[:-1]
        both = np.add.reduceat((own[place] == flat).astype(np.int64), bounds)
        linked = 100 * both >= percent * (sizes[a] + sizes[others] - both)
        for b in others[linked].tolist():
            links[a] = links.get(a, 0) + members[b][7]
            links[b] = links.get(b, 0) + members[a][7]
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
                forest.append((a, b))
    return links, forest


_NAMES = ["pivot", "low", "high", "class", "other", "links"]
_RESULT = "pivot long, low int, high int, class binary, other binary, links long"
_RESULT_ARROW = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64()]


def _by_group(work, whole: bool):
    """Run ``work(key, members)`` for the rows of each (pivot, low, high), which stand together."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members = None, {}
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _RESULT_ARROW, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=_NAMES)

        def close() -> None:
            if len(members) > 1:
                out.extend(work(key, list(members.values())))

        for batch in rows:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for pivot, low, high, owner, block, n, matches, pivots, front, *more in zip(*columns, strict=True):
                if (pivot, low, high) != key:
                    if key is not None:
                        close()
                    key, members = (pivot, low, high), {}
                sets = (np.frombuffer(front, np.uint64), np.frombuffer(more[0], np.uint64), more[1]) if whole else (np.frombuffer(front, np.uint64),)
                members[owner] = (owner, block, n, matches, pivots, *sets)
            if out:
                yield flush()
        if key is not None:
            close()
        if out:
            yield flush()

    return run


def _hopeful(percent: int):
    """Members with a candidate; ``links`` holds their block."""

    def work(key: tuple, members: list[tuple]) -> list[tuple]:
        found: set[int] = set()
        for a, others in candidates(key[0], key[1] != key[2], members, percent):
            found.add(a)
            found.update(others.tolist())
        return [(*key, members[i][0], None, members[i][1]) for i in found]

    return _by_group(work, whole=False)


def _verified(percent: int):
    """Link counts and forest edges."""

    def work(key: tuple, members: list[tuple]) -> list[tuple]:
        links, forest = compare(key[0], key[1] != key[2], members, percent)
        found = [(*key, members[i][0], None, n) for i, n in links.items()]
        return found + [(*key, members[a][0], members[b][0], None) for a, b in forest]

    return _by_group(work, whole=True)


def _filter_of(hashes: DataFrame) -> np.ndarray:
    """Bytes of a bitmap with a set bit for each of two parts of every hash."""
    part = F.explode(F.array(*[F.pmod(F.shiftright("hash", shift), F.lit(1 << FILTER_BITS)) for shift in (0, 32)])).alias("bit")
    # an aggregated bitmap has 2^15 bits
    rows = (
        hashes.select(part)
        .groupBy(F.shiftright("bit", 15).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.col("bit").bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))
        .collect()
    )
    found = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for row in rows:
        bits = np.frombuffer(row["bits"], np.uint8)
        found[row["bucket"] * len(bits) :][: len(bits)] = bits
    return found


def _may_hold(shared):
    @F.pandas_udf("boolean")
    def test(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for hashes in parts:
            bits, values = shared.value, hashes.to_numpy(np.int64)
            found = np.ones(len(values), bool)
            for shift in (0, 32):
                at = (values >> shift) & ((1 << FILTER_BITS) - 1)
                found &= (bits[at >> 3] >> (at & 7)).astype(np.uint8) & 1 == 1
            yield pd.Series(found)
        release_memory()

    return test


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge (a, b); the root is the least node it reaches."""
    edges = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct()
    stars, before = materialize(edges), None
    while True:
        both = stars.unionByName(stars.select(F.col("root").alias("node"), F.col("node").alias("root")))
        # large star: larger neighbours of a node go to the least of its neighbourhood
        least = both.groupBy("node").agg(F.min("root").alias("low")).select("node", F.least("node", "low").alias("low"))
        large = both.join(least, "node").filter(F.col("root") > F.col("node")).select(F.col("root").alias("node"), F.col("low").alias("root")).distinct()
        # small star: a node and its smaller neighbours go to the least of them
        lowest = large.groupBy("node").agg(F.min("root").alias("low"))
        small = large.join(lowest, "node").filter(F.col("root") != F.col("low")).select(F.col("root").alias("node"), F.col("low").alias("root"))
        last, stars = stars, materialize(small.unionByName(lowest.withColumnRenamed("low", "root")).distinct())
        discard(last)
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        if state == before:
            return stars
        before = state


def link(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, n_links, stays) of each document.

    ``n_links`` counts the other documents linked with it, copies included.  ``stays`` is true
    for one distinct (doc_id, text) of each component, and for empty sets.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    profiles = materialize(texts.mapInArrow(releasing(_profile(words)), _PROFILE))
    sets = profiles.filter(F.col("chunk").isNull()).select("doc_id", "text_hash", "class", "number", "n")
    # a fixed number of counters
    order = spark.sparkContext.broadcast(Order(_sketch(profiles), percent))

    postings = texts.select("text").mapInArrow(releasing(_postings(order, words)), "token long, number long, n int")
    sorted_ = postings.repartition("token").sortWithinPartitions("token", "n", "number")
    grouped = sorted_.mapInArrow(releasing(_pivots(percent)), "pivot long, number long, n int")
    posted = materialize(grouped.groupBy("pivot", "number", "n").agg(F.count("*").alias("shared")))
    # the least l of any partner: that of a set of the least size which can be linked
    least = F.floor(F.ceil(F.col("n") * percent / 100) / SHARE) + 1
    least = F.least(least, F.ceil(F.ceil(F.col("n") * percent / 100) * percent / 100))
    able = posted.groupBy("number", "n").agg(F.sum("shared").alias("shared")).filter(F.col("shared") >= least).select("number")
    left = posted.join(able, "number", "left_semi")
    pairs = left.groupBy("pivot").agg(F.count("*").alias("classes")).filter("classes > 1").select("pivot")
    members = left.join(pairs, "pivot", "left_semi")
    blocks = members.groupBy("pivot").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    groups = members.join(blocks, "pivot").groupBy("number").agg(F.collect_list(F.struct("pivot", "blocks")).alias("groups"))

    classes = (
        sets.filter("n > 0")
        .groupBy("class", "number")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")).alias("first"), F.count("*").alias("copies"))
    )
    wanted = groups.join(classes, "number").select("class", "copies", "groups", F.col("first.doc_id").alias("w_id"), F.col("first.text_hash").alias("w_hash"))
    wanted = materialize(wanted)
    discard(posted)
    held = spark.sparkContext.broadcast(_filter_of(wanted.select(F.col("w_hash").alias("hash"))))
    # an exchange between the filter and the sets: a task of both would keep two Python workers
    found = texts.filter(_may_hold(held)("text_hash")).join(wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("text_hash") == F.col("w_hash")))
    stored = materialize(found.select("text", "class", "copies", "groups").mapInArrow(releasing(_sets(order, words)), _SETS))
    discard(wanted)
    key = ["pivot", "low", "high"]
    placed = _placed(stored).repartition(*key).sortWithinPartitions(*key).mapInArrow(releasing(_hopeful(percent)), _RESULT)
    hopeful = materialize(placed.select(*key, "class", F.col("links").cast("int").alias("block")))
    # classes with a candidate come again, to those of their groups where they have it
    pivots = F.array_sort(F.transform("groups", lambda g: g["pivot"])).alias("pivots")
    linked = materialize(
        hopeful.join(stored.select("class", "n", "matches", pivots, "front", "rest", "copies"), "class")
        .select(*key, "class", "block", "n", "matches", "pivots", "front", "rest", "copies")
        .repartition(*key)
        .sortWithinPartitions(*key)
        .mapInArrow(releasing(_verified(percent)), _RESULT)
        .select("class", "other", "links")
    )
    # nothing reads these any more
    discard(stored, hopeful)
    stars = components(linked.filter(F.col("other").isNotNull()).select(F.col("class").alias("a"), F.col("other").alias("b")))
    links = linked.filter(F.col("other").isNull()).groupBy("class").agg(F.sum("links").alias("links"))

    named = classes.join(stars, classes["class"] == stars["node"], "left").select(
        "class", "first", "copies", F.coalesce("root", "class").alias("component")
    )
    least = named.groupBy("component").agg(F.min("first").alias("least"))
    by_class = named.join(least, "component").join(links, "class", "left").select(
        "class", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    shared = F.col("n") > 0
    chosen = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))
    return sets.join(by_class, "class", "left").select(
        "doc_id",
        "text_hash",
        F.col("n").alias("n_shingles"),
        F.when(shared, F.col("least.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(shared, chosen).otherwise(F.lit(True)).alias("stays"),
    )


def one_of_each_group(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` with one document of each component; of repeated rows one stays."""
    # a null doc_id gets a number, so that the join and the removal of repeated rows share one exchange
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    found = link(docs, words, percent).filter("stays").select(number.alias("r_id"), F.col("text_hash").alias("r_hash")).distinct()
    rows = docs.select(F.struct("*").alias("doc"), number.alias("r_id"), F.xxhash64("text").alias("r_hash"))
    return rows.join(found, ["r_id", "r_hash"], "left_semi").dropDuplicates(["r_id", "r_hash"]).select("doc.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")


SQL = None
