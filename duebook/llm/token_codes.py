"""Token ids in files of directly addressable codes.

An id is cut into chunks of ``CHUNK_BITS`` bits.  Level 0 holds the lowest chunk of every
id; a continuation bitmap tells which ids go on at the next level, and a rank directory
holds the number of set bits before every ``RANK_STEP`` bits.  The chunk of id ``i`` at the next level
therefore stands at ``rank(i)``: any token is read by one look-up a level, without decoding
others.

A file is a table of segments in ascending document order: a segment holds up to
``SEGMENT_TOKENS`` tokens of consecutive documents (or one longer document) as one binary
value, and an index of its documents.  Spark's writer stores the segments in the shared
folder, so any file system that Spark knows works and a lost task writes its part anew.

Edge cases: a null or empty text has only the end id; repeated ``doc_id`` values stand side
by side, ordered by a hash of the text; a null ``doc_id`` comes first; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.llm.shared import batches, release_memory, table, worker_encoder
from duebook.session import materialize

CHUNK_BITS = 8
RANK_STEP = 512
SEGMENT_TOKENS = 1 << 20
END = 2
BATCH_BYTES = 2 << 20

_AT_ONCE = 4096
_SET_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.int64)

_FILE = "part int, segment int, start long, n_tokens long, doc_ids array<long>, ends array<long>, codes binary"


def _ranks(more: np.ndarray, ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of set bits before each place: the directory's entry, then the bytes and bits after it."""
    block, byte = at // RANK_STEP, at >> 3
    after = (block * (RANK_STEP // 8))[:, None] + np.arange(RANK_STEP // 8)
    whole = np.where(after < byte[:, None], _SET_BITS[more[np.minimum(after, len(more) - 1)]], 0).sum(axis=1)
    return ranks[block].astype(np.int64) + whole + _SET_BITS[more[byte] & ((1 << (at & 7)) - 1)]


class Codes:
    """One encoded sequence of ids."""

    def __init__(self, data: bytes):
        n_levels, self.bits = struct.unpack_from("<HH", data, 0)
        self.levels, at = [], 4
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", data, at)
            at += 8
            width = np.dtype(f"<u{max(1, self.bits // 8)}")
            chunks = np.frombuffer(data, width, n, at)
            at += n * width.itemsize
            size = -(-n // 8)
            more = np.frombuffer(data, np.uint8, size, at)
            at += size
            steps = n // RANK_STEP + 1
            ranks = np.frombuffer(data, "<u8", steps, at)
            at += 8 * steps
            self.levels.append((n, chunks, more, ranks))

    @staticmethod
    def encode(ids: np.ndarray, bits: int = CHUNK_BITS) -> bytes:
        """The bytes of unsigned 32-bit ``ids``; ``bits`` is 8 or 16."""
        rest, levels = np.asarray(ids, np.uint32), []
        while True:
            chunks = (rest & np.uint32((1 << bits) - 1)).astype(f"<u{bits // 8}")
            higher = rest >> np.uint32(bits)
            more = higher > 0
            packed = np.packbits(more, bitorder="little")
            blocks = np.zeros((len(rest) // RANK_STEP + 1, RANK_STEP // 8), np.uint8)
            blocks.reshape(-1)[: len(packed)] = np.bitwise_count(packed)
            own = blocks.sum(axis=1, dtype="<u8")
            before = np.cumsum(own, dtype="<u8") - own
            levels.append(struct.pack("<Q", len(rest)) + chunks.tobytes() + packed.tobytes() + before.tobytes())
            if not more.any():
                return struct.pack("<HH", len(levels), bits) + b"".join(levels)
            rest = higher[more]

    def __len__(self) -> int:
        return self.levels[0][0]

    def __getitem__(self, i: int) -> int:
        """Id number ``i``, by one look-up a level."""
        value, shift = 0, 0
        for n, chunks, more, ranks in self.levels:
            if not 0 <= i < n:
                raise IndexError(i)
            value |= int(chunks[i]) << shift
            if not more[i >> 3] >> (i & 7) & 1:
                return value
            block = i // RANK_STEP
            # whole bytes from the directory entry on, then the bits below i
            part = more[block * RANK_STEP // 8 : (i >> 3) + 1].copy()
            part[-1] &= (1 << (i & 7)) - 1
            i = int(ranks[block]) + int(np.unpackbits(part).sum())
            shift += self.bits
        return value

    def take(self, places: np.ndarray) -> np.ndarray:
        """The ids at many places, each by one look-up a level."""
        at, found = np.asarray(places, np.int64), np.zeros(len(places), np.uint32)
        rows, shift = np.arange(len(at)), 0
        for n, chunks, more, ranks in self.levels:
            if not len(at):
                break
            if at.min() < 0 or at.max() >= n:
                raise IndexError(f"a place outside 0 to {n - 1}")
            found[rows] |= chunks[at].astype(np.uint32) << np.uint32(shift)
            on = more[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1
            at, rows, shift = at[on], rows[on], shift + self.bits
            at = np.concatenate([_ranks(more, ranks, at[k : k + _AT_ONCE]) for k in range(0, len(at), _AT_ONCE)] or [at])
        return found

    def decode(self) -> np.ndarray:
        """All ids, level by level."""
        values = None
        for n, chunks, more, _ in reversed(self.levels):
            level = chunks.astype(np.uint32)
            if values is not None:
                at = np.flatnonzero(np.unpackbits(more, bitorder="little", count=n))
                level[at] |= values << np.uint32(self.bits)
            values = level
        return values


def _segments(path: str, end: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, start = TaskContext.get().partitionId(), 0, 0
        encoder = worker_encoder(path)
        close = np.array([end], "<u4")
        doc_ids, ends, ids, n = [], [], [], 0

        def segment() -> pa.RecordBatch:
            codes = Codes.encode(np.concatenate(ids))
            values = [[part], [number], [start], [n], [doc_ids], [ends], [codes]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            names = ["part", "segment", "start", "n_tokens", "doc_ids", "ends", "codes"]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names=names)

        for batch in batches(rows, "text", BATCH_BYTES):
            texts = encoder.encode_all(batch.column(1).to_pylist())
            for doc_id, new in zip(batch.column(0).to_pylist(), texts, strict=True):
                if n and n + len(new) + 1 > SEGMENT_TOKENS:
                    yield segment()
                    doc_ids, ends, ids, n, number, start = [], [], [], 0, number + 1, start + n
                ids += [new, close]
                n += len(new) + 1
                doc_ids.append(doc_id)
                ends.append(n)
        if n:
            yield segment()
        release_memory()

    return run


def write_codes(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """Write the ids of all texts in ascending ``doc_id`` order and return the written segments."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(partitions, F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    )
    return materialize(ordered.mapInArrow(_segments(path, end), _FILE))


def _documents(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of each segment: place in the writer's part, length and checksum.

    The first and the last id of every document are also read by direct access, through the
    rank directories, and must equal those of the decoded levels.
    """
    for batch in rows:
        for k in range(batch.num_rows):
            part, start, doc_ids, ends, data = (batch.column(i)[k].as_py() for i in range(5))
            codes = Codes(data)
            ids = codes.decode().astype("<u4", copy=False)
            starts = [0, *ends[:-1]]
            at = np.array([*starts, *(e - 1 for e in ends)], np.int64)
            if len(wrong := at[codes.take(at) != ids[at]]):
                raise ValueError(f"id {wrong[0]} of a segment differs between direct access and decoding")
            checks = [zlib.crc32(ids[a:b]) for a, b in zip(starts, ends, strict=True)]
            n = len(ends)
            arrays = [pa.array([part] * n, pa.int32()), pa.array(doc_ids, pa.int64()), pa.array([start + a for a in starts], pa.int64())]
            arrays += [pa.array([b - a for a, b in zip(starts, ends, strict=True)], pa.int64()), pa.array(checks, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["part", "doc_id", "place", "n_tokens", "ids_crc32"])


def read_documents(segments: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read back from written segments."""
    spark = segments.sparkSession
    # the totals of the writer's partitions, as many as it had; places within them are stored
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    before, total = [], 0
    for row in parts:
        before.append((row["part"], total))
        total += row["n"]
    offsets = F.broadcast(spark.createDataFrame(before, "part int, part_start long"))
    rows = segments.select("part", "start", "doc_ids", "ends", "codes").mapInArrow(
        _documents, "part int, doc_id long, place long, n_tokens long, ids_crc32 long"
    )
    return rows.join(offsets, "part").select("doc_id", (F.col("part_start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return read_documents(write_codes(docs, public_tokenizers.path("byte_bpe_50k.json")))


SQL = None
