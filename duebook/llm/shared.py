"""Readers and small helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space as the contracts of the queries define it: space, tab, LF, VT, FF, CR
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Give the Python workers of the session this package, once per application."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    _SHIPPED[application] = folder = tempfile.TemporaryDirectory(prefix="duebook-package-")
    path = os.path.join(os.path.realpath(folder.name), "duebook_package.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for at, _, names in sorted(os.walk(package)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(at, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other letter as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def byte_table(is_word, lower: bool = True) -> bytes:
    """A translation of UTF-8 bytes: bytes outside words become a space, A-Z is lower-cased."""
    out = bytearray()
    for b in range(256):
        c = b + 32 if lower and 65 <= b <= 90 else b
        out.append(c if is_word(c) else 32)
    return bytes(out)


# words made of digits, a-z and every code point above ASCII
ALNUM_WORDS = byte_table(lambda c: 48 <= c <= 57 or 97 <= c <= 122 or c >= 128)
# words made of anything but ASCII white space
SPACED_WORDS = byte_table(lambda c: chr(c) not in WHITE)


def batches(rows: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of incoming batches whose ``column`` holds about ``max_bytes`` (one row at least)."""
    for batch in rows:
        sizes = batch.column(column).cast(pa.binary()) if pa.types.is_string(batch.column(column).type) else batch.column(column)
        lengths = np.asarray(pa.compute.binary_length(sizes).fill_null(0))
        total, start = 0, 0
        for i, size in enumerate(lengths):
            if i > start and total + size > max_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(size)
        if batch.num_rows > start:
            yield batch.slice(start)


# letters that no other character combines with under case folding or normalisation: ASCII ones, and those of
# Latin-1, which are the byte C3 and one more in UTF-8, but for the signs of multiplication and division
_ASCII_LETTERS = bytes(65 <= b <= 90 or 97 <= b <= 122 for b in range(256))
_LATIN_LEAD, _SIGNS = 0xC3, (0x97, 0xB7)


def _letters(data: np.ndarray) -> np.ndarray:
    """True for each byte that is part of a letter."""
    found = np.frombuffer(bytearray(data.tobytes().translate(_ASCII_LETTERS)), bool)
    lead = np.flatnonzero(data[:-1] == _LATIN_LEAD)
    after = data[lead + 1]
    lead = lead[(after != _SIGNS[0]) & (after != _SIGNS[1])]
    found[lead] = found[lead + 1] = True
    return found


def _parts(chunks: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The places where chunks begin, with the end of the last, and the bytes."""
    _, places, data = chunks.buffers()
    places = np.frombuffer(places, np.int64)[chunks.offset : chunks.offset + len(chunks) + 1]
    return places, np.frombuffer(data or b"", np.uint8)


def _hashes(chunks: pa.LargeBinaryArray) -> np.ndarray:
    """A 64-bit polynomial of the bytes of each chunk; none is empty."""
    places, data = _parts(chunks)
    sizes = np.diff(places)
    powers = np.multiply.accumulate(np.full(sizes.max(), 0x9E3779B97F4A7C15, np.uint64))
    within = np.arange(places[0], places[-1]) - np.repeat(places[:-1], sizes)
    return np.add.reduceat(powers[within] * (data[places[0] : places[-1]] + np.uint64(1)), places[:-1] - places[0])


def _equal(one: pa.LargeBinaryArray, rows: np.ndarray, other: pa.LargeBinaryArray, to: np.ndarray) -> np.ndarray:
    """Whether the chunks ``rows`` of one array are the chunks ``to`` of another, byte for byte."""
    (a, data), (b, known) = _parts(one), _parts(other)
    same = a[rows + 1] - a[rows] == b[to + 1] - b[to]
    rows, to = rows[same], to[same]
    if len(rows):
        sizes = a[rows + 1] - a[rows]
        first = np.cumsum(sizes) - sizes
        step = np.arange(first[-1] + sizes[-1])
        match = data[np.repeat(a[rows] - first, sizes) + step] == known[np.repeat(b[to] - first, sizes) + step]
        same[same] = np.logical_and.reduceat(match, first)
    return same


def release_memory() -> None:
    """Give memory that Arrow and the allocator keep back to the system, where the C library can; idle workers hold it otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    library = ctypes.CDLL(None)
    if hasattr(library, "malloc_trim"):
        library.malloc_trim(0)


def releasing(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` over the batches of a task; the worker gives its memory back when the task ends."""

    def run(rows: Iterator) -> Iterator:
        yield from work(rows)
        release_memory()

    return run


@lru_cache(maxsize=4)
def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class CachedEncoder:
    """Token ids of whole texts by the ``tokenizers`` library, each distinct chunk encoded once.

    Both vocabularies used here never join characters across a single space or line feed
    between two other characters, nor across the end of a run of letters before an ASCII
    character that is no letter.  All texts of a batch are cut there at once; chunks not seen before
    go to the library in one call, joined by a separator that is always one token of its own, and
    the ids of the texts are gathered from one packed buffer.  Texts with other or repeated
    white space, or with a separator, go to the library whole.  ``tests/llm`` compares the ids with
    those of uncut texts.  Beyond ``limit`` chunks the buffer starts anew.
    """

    def __init__(self, path: str, limit: int = 400_000):
        self.library, self.limit = _library(path), limit
        # a vocabulary that keeps white space has a token for the line feed
        kept = self._ids("\n")
        self.keeps_white = len(kept) == 1
        self.separator = "\n" if self.keeps_white else " \x01 "
        (self.mark,) = kept if self.keeps_white else self._ids("\x01")
        self._forget()

    def _forget(self) -> None:
        # the chunks as one Arrow array: some 60 bytes each with all numbers, where a dict of bytes takes 150
        kept = [b"\n"] if self.keeps_white else []
        self.known = pa.array(kept, pa.large_binary())
        self.packed = np.array([self.mark] * len(kept), "<u4")
        self.ends = np.arange(len(kept) + 1)
        # sorted hashes with the numbers of their chunks; the last entry belongs to none
        self.hashes, self.numbers = np.array([2**64 - 1], np.uint64), np.array([-1])
        if kept:
            self._enter(_hashes(self.known))

    def _enter(self, hashes: np.ndarray) -> None:
        """Add the hashes of the newest chunks; of equal ones the oldest is found, so the line feed always is."""
        order, size = np.argsort(hashes, kind="stable"), len(self.known) - len(hashes)
        at = np.searchsorted(self.hashes, hashes[order], side="right")
        self.hashes, self.numbers = np.insert(self.hashes, at, hashes[order]), np.insert(self.numbers, at, size + order)

    def _ids(self, text: str) -> np.ndarray:
        return np.asarray(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _odd(self, text: str) -> bool:
        """White space other than single spaces and line feeds inside the text, or a separator."""
        if text[0] in " \n" or text[-1] in " \n" or not text.replace("\n", "").isprintable():
            return True
        return "  " in text or "\n\n" in text or " \n" in text or "\n " in text

    def _chunks(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the chunks of texts joined by line feeds."""
        white = (data == 32) | (data == 10)
        starts = np.flatnonzero(~white & np.append(True, white[:-1]))
        ends = np.flatnonzero(~white & np.append(white[1:], True)) + 1
        other = np.append(np.flatnonzero(~_letters(data)), len(data))
        # a word that starts with letters and goes on with an ASCII sign is cut there
        stop = other[np.searchsorted(other, starts)]
        cut = (stop > starts) & (stop < ends)
        cut[cut] = data[stop[cut]] < 128
        first = starts - (np.append(10, data)[starts] == 32) if self.keeps_white else starts
        own, cut_at = [first, stop[cut]], [np.where(cut, stop, ends), ends[cut]]
        if self.keeps_white:
            lines = np.flatnonzero(data == 10)
            own.append(lines)
            cut_at.append(lines + 1)
        own, cut_at = np.concatenate(own), np.concatenate(cut_at)
        order = np.argsort(own, kind="stable")
        return own[order], cut_at[order]

    def _learn(self, words: pa.LargeBinaryArray) -> None:
        """Encode new chunks, none of them a line feed, and add their ids to the packed buffer."""
        joined = pa.compute.binary_join(pa.LargeListArray.from_arrays([0, len(words)], words), pa.scalar(self.separator.encode(), pa.large_binary()))
        ids = self._ids(joined[0].as_buffer().to_pybytes().decode())
        marks = ids == self.mark
        lengths = np.diff(np.append(np.flatnonzero(marks), len(ids)), prepend=-1) - 1
        self.known = pa.concat_arrays([self.known, words])
        self.packed = np.concatenate((self.packed, ids[~marks]))
        self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(lengths)))

    def _places(self, chunks: pa.LargeBinaryArray) -> np.ndarray:
        """The number of each distinct chunk; new ones are encoded first."""
        if len(self.known) > self.limit:
            self._forget()
        hashes = _hashes(chunks)
        slots = np.searchsorted(self.hashes, hashes)
        at = np.where(self.hashes[slots] == hashes, self.numbers[slots], -1)
        # an equal hash is no equal chunk yet
        rows = np.flatnonzero(at >= 0)
        at[rows[~_equal(chunks, rows, self.known, at[rows])]] = -1
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = len(self.known) + np.arange(len(new))
            self._learn(chunks.take(pa.array(new)))
            self._enter(hashes[new])
        return at

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        out: list[np.ndarray] = [np.empty(0, "<u4")] * len(texts)
        plain = [i for i, t in enumerate(texts) if t and not self._odd(t)]
        for i in sorted({i for i, t in enumerate(texts) if t} - set(plain)):
            out[i] = self._ids(texts[i])
        if not plain:
            return out
        parts = [texts[i].encode() for i in plain]
        whole = b"\n".join(parts)
        data = np.frombuffer(whole, np.uint8)
        starts, ends = self._chunks(data)
        begins = np.cumsum([0, *[len(p) + 1 for p in parts]])
        if self.keeps_white:
            # every byte is in a chunk, so the texts are read as they stand
            offsets, packed = np.append(starts, len(data)), data
        else:
            offsets = np.append(0, np.cumsum(ends - starts))
            packed = data[np.repeat(starts - offsets[:-1], ends - starts) + np.arange(offsets[-1])]
        buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(packed)]
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        of_chunk = np.asarray(coded.indices)
        if self.keeps_white:
            # the line feeds between two texts belong to none
            between = np.searchsorted(starts, begins[1:-1] - 1)
            of_chunk, starts = np.delete(of_chunk, between), np.delete(starts, between)
        at = self._places(coded.dictionary)[of_chunk]
        low, high = self.ends[at], self.ends[at + 1]
        places = np.append(0, np.cumsum(high - low))
        ids = self.packed[np.repeat(low - places[:-1], high - low) + np.arange(places[-1])]
        # the chunks of a text start before the next text
        of_text = places[np.searchsorted(starts, begins, side="left")]
        for i, a, z in zip(plain, of_text.tolist(), of_text[1:].tolist(), strict=False):
            out[i] = ids[a:z]
        return out

    def __call__(self, text: str | None) -> bytes:
        """Ids of one text as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0].tobytes()


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> CachedEncoder:
    """One encoder for all tasks of a Python worker, so that its chunks are encoded once a worker and not once a task.

    It holds some 60 bytes a chunk; what it knows never changes the ids of a text.
    """
    return CachedEncoder(path, limit=1_000_000)
