"""Best-fit packing after dominance reduction of the bin packing instance.

Only the histogram of piece lengths decides how many pieces go together, and it has at most
``capacity`` entries whatever the corpus is.  The plan is made on it: first the reduction of
Martello and Toth, which takes each length, the longest first, and fixes it with a set of at
most two more pieces while that set provably dominates every other set that fits (some optimal
packing contains it); the instance shrinks by what is fixed, and the remainder goes by best
fit over decreasing lengths.  Each step handles all pieces of a length at once.

Spark then deals the pieces out: their rank among equal lengths comes from a distributed
count, and (length, rank) falls into one interval of the plan, which names the sequence and
the place in it.

Edge cases: a null or empty text has only the end id; repeated rows are packed one by one;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duebook.llm.shared import CachedEncoder, batches, release_memory, table
from duebook.session import materialize

CAPACITY = 4096
END = 1
BATCH_BYTES = 2 << 20

_PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, local_rank long"


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """One row per piece, with its rank among equal lengths of the same task; stored, so the ranks stay."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        # the encoder and its chunks end with the task
        encoder, seen = CachedEncoder(path), [0] * (capacity + 1)
        close = np.array([end], "<u4")
        for batch in batches(rows, "text", BATCH_BYTES):
            out: list[tuple] = []
            texts = encoder.encode_all(batch.column(1).to_pylist())
            for doc_id, ids in zip(batch.column(0).to_pylist(), texts, strict=True):
                ids = np.append(ids, close)
                for piece, at in enumerate(range(0, len(ids), capacity)):
                    own = ids[at : at + capacity]
                    n = len(own)
                    out.append((doc_id, piece, at, n, zlib.crc32(own.tobytes()), part, seen[n]))
                    seen[n] += 1
            if out:
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
                arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "local_rank"])
        del encoder
        release_memory()

    return materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _PIECES))


class Plan:
    """Patterns (lengths of one sequence, number of such sequences) for a histogram of lengths."""

    def __init__(self, histogram: dict[int, int], capacity: int = CAPACITY):
        self.capacity = capacity
        self.left = {s: n for s, n in histogram.items() if n > 0}
        self.sizes = sorted(self.left)
        self.patterns: list[tuple[tuple[int, ...], int]] = []
        self.fixed = 0
        self._reduce()
        self._best_fit()

    def _take(self, pattern: tuple[int, ...], times: int) -> None:
        self.patterns.append((pattern, times))
        for s in pattern:
            self.left[s] -= times
        for s in set(pattern):
            if not self.left[s]:
                del self.left[s]
                self.sizes.pop(bisect.bisect_left(self.sizes, s))

    def _largest(self, room: int, without: tuple[int, ...]) -> int | None:
        """The longest length that fits into ``room``, beside pieces already in use."""
        i = bisect.bisect_right(self.sizes, room) - 1
        while i >= 0:
            s = self.sizes[i]
            if self.left[s] > without.count(s):
                return s
            i -= 1
        return None

    def _smallest(self, without: tuple[int, ...], count: int) -> list[int]:
        found: list[int] = []
        for s in self.sizes:
            found += [s] * min(count - len(found), self.left[s] - without.count(s))
            if len(found) == count:
                break
        return found

    def _dominating(self, longest: int) -> tuple[int, ...] | None:
        """A set with ``longest`` that dominates all others which fit, if one is found."""
        room = self.capacity - longest
        one = self._largest(room, (longest,))
        if one is None:
            return (longest,)
        small = self._smallest((longest,), 3)
        # a perfect fit dominates; so does the longest partner when two never fit beside
        if one == room or len(small) < 2 or small[0] + small[1] > room:
            return (longest, one)
        # beside it at most two fit: the best pair, unless the single piece is as long as any pair's sum
        if len(small) < 3 or sum(small) > room:
            pair = self._best_pair(room, longest)
            if pair is None or one >= sum(pair):
                return (longest, one)
            # the pair replaces any other pair or single piece if it covers them one by one
            if one <= max(pair) and self._covers(pair, room, longest):
                return (longest, *pair)
        return None

    def _best_pair(self, room: int, longest: int) -> tuple[int, int] | None:
        best = None
        for s in reversed(self.sizes[: bisect.bisect_right(self.sizes, room)]):
            if 2 * s < (sum(best) if best else 0):
                break
            if self.left[s] > (s == longest):
                other = self._largest(min(s, room - s), (longest, s))
                if other is not None and (best is None or s + other > sum(best)):
                    best = (s, other)
        return best

    def _covers(self, pair: tuple[int, int], room: int, longest: int) -> bool:
        """Every other feasible pair (a >= b) has a <= pair[0] and b <= pair[1]."""
        high, low = max(pair), min(pair)
        widest = self._largest(room - self.sizes[0], (longest, self.sizes[0]))
        if widest is not None and widest > high:
            return False
        # a lower member above ``low`` would need another piece at least as long beside it
        i = bisect.bisect_right(self.sizes, low)
        while i < len(self.sizes) and 2 * self.sizes[i] <= room:
            s = self.sizes[i]
            for t in self.sizes[i:]:
                if s + t > room:
                    break
                if s != t or self.left[s] > 1:
                    return False
            i += 1
        return True

    def _reduce(self) -> None:
        """Fix dominating sets for every length, the longest first.

        Fixing a set only removes pieces, so the proof holds again while its lengths last.
        """
        for longest in self.sizes[::-1]:
            while longest in self.left:
                pattern = self._dominating(longest)
                if pattern is None:
                    break
                times = min(self.left[s] // pattern.count(s) for s in set(pattern))
                self._take(pattern, times)
                self.fixed += times

    def _best_fit(self) -> None:
        """The remaining pieces into the open sequence with least room that takes them."""
        rooms: list[int] = []
        open_at: dict[int, list[list]] = {}

        def put(room: int, pattern: tuple[int, ...], times: int) -> None:
            if room not in open_at or not open_at[room]:
                open_at[room] = []
                if room not in rooms:
                    bisect.insort(rooms, room)
            open_at[room].append([pattern, times])

        for s in reversed(self.sizes[:]):
            n = self.left[s]
            while n:
                i = bisect.bisect_left(rooms, s)
                if i == len(rooms):
                    # new sequences take as many of this length as fit, the last one the rest
                    each = min(n, self.capacity // s)
                    times = n // each
                    put(self.capacity - each * s, (s,) * each, times)
                    n -= times * each
                    continue
                room = rooms[i]
                group = open_at[room]
                pattern, times = group[-1]
                each = min(room // s, n)
                used = min(times, n // each)
                group[-1][1] -= used
                if not group[-1][1]:
                    group.pop()
                if not group:
                    rooms.pop(i)
                    del open_at[room]
                put(room - each * s, pattern + (s,) * each, used)
                n -= used * each
        for group in open_at.values():
            self.patterns += [(pattern, times) for pattern, times in group]

    def slots(self) -> list[tuple[int, int, int, int, int]]:
        """(length, first rank, last rank + 1, first sequence, offset): one sequence for each rank."""
        out, used, sequence = [], {}, 0
        for pattern, times in self.patterns:
            offset = 0
            for s in pattern:
                rank = used.get(s, 0)
                out.append((s, rank, rank + times, sequence, offset))
                used[s] = rank + times
                offset += s
            sequence += times
        return out


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to the pieces of ``pieces_of``."""
    spark = pieces.sparkSession
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    # rows of one length: one for each task of the writer at most
    earlier = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    counts = counts.select("length", "part", "n", earlier.alias("earlier"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = sorted(Plan(histogram, capacity).slots())
    lengths = np.array([s[0] for s in slots], np.int64)
    firsts = np.array([s[1] for s in slots], np.int64)
    sequences = np.array([s[3] for s in slots], np.int64)
    offsets = np.array([s[4] for s in slots], np.int64)
    # the plan depends on the lengths, of which there are at most ``capacity``
    shared = spark.sparkContext.broadcast((lengths, firsts, sequences, offsets))

    def place(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, firsts, sequences, offsets = shared.value
        bounds: dict[int, tuple[int, int]] = {}
        for batch in rows:
            length = np.asarray(batch.column(3)).astype(np.int64)
            rank = np.asarray(batch.column(5)).astype(np.int64)
            at = np.empty(len(length), np.int64)
            for s in np.unique(length).tolist():
                if s not in bounds:
                    bounds[s] = (int(np.searchsorted(lengths, s)), int(np.searchsorted(lengths, s, side="right")))
                low, high = bounds[s]
                own = length == s
                at[own] = low + np.searchsorted(firsts[low:high], rank[own], side="right") - 1
            arrays = [batch.column(i) for i in range(3)] + [pa.array(length), batch.column(4), pa.array(sequences[at] + rank - firsts[at]), pa.array(offsets[at])]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = pieces.join(counts.select("length", "part", "earlier"), ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("local_rank") + F.col("earlier")).alias("rank")
    )
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def packed(docs: DataFrame) -> DataFrame:
    """Pieces of all documents with their places, by the vocabulary of the query."""
    import public_tokenizers

    return pack(pieces_of(docs, public_tokenizers.path("word_bpe_49k.json")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


SQL = None
