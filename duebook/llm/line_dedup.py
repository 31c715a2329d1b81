"""Line deduplication by range-partitioned line hashes, with keep bitmaps as the result.

Lines are reduced to (128-bit hash of the key, document, position), range-partitioned by
hash and document and sorted, so equal keys stand together, the largest document first.
Each task streams over its sorted rows with a few rows of state.  A key whose rows reach
across a partition border (a line of a third of all documents fills many partitions) is
settled afterwards from one summary row per border; a document never spans a border,
because the ranges are cut by (key, document).  The result is a compressed bitmap of the
kept lines of each document; texts move only when a caller applies the bitmaps.

Edge cases: null or empty text is one empty line.  Documents are distinct ``doc_id`` values;
a null ``doc_id`` counts as one document smaller than all others.  Repeated rows get the same
bitmap.  Extra columns are ignored by ``keep_bitmaps`` and kept by ``apply_bitmaps``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.llm.shared import WHITE, lower_ascii, releasing
from duebook.session import materialize

MIN_CHARS = 40
MIN_DOCUMENTS = 5

DROPPED, WAITING, SUMMARY = 0, 1, 2
_STREAMED = "kind int, h1 long, h2 long, doc_id long, text_hash long, position int, documents long"
_ARROW = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
_NAMES = ["kind", "h1", "h2", "doc_id", "text_hash", "position", "documents"]
# stands for a null doc_id
NO_DOCUMENT = -(2**63)


def _stream(min_documents: int):
    """The pass over the sorted rows of one partition."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first_key, documents, largest, last = None, None, 0, None, None
        pending: list[tuple] = []  # rows of smaller documents while the key may stay below the limit
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _ARROW, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=_NAMES)

        for batch in rows:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for h1, h2, doc, text_hash, position in zip(*columns, strict=True):
                if (h1, h2) != key:
                    if key is None:
                        first_key = (h1, h2)
                    elif key == first_key:
                        out.append((SUMMARY, *key, largest, None, None, documents))
                    key, documents, largest, last, pending = (h1, h2), 0, doc, None, []
                if doc != last:
                    documents, last = documents + 1, doc
                if key == first_key:
                    # earlier partitions may hold larger documents of this key
                    out.append((WAITING, h1, h2, doc, text_hash, position, None))
                elif doc != largest:
                    pending.append((doc, text_hash, position))
                    if documents >= min_documents:
                        out.extend((DROPPED, None, None, *row, None) for row in pending)
                        pending = []
                if len(out) >= 20_000:
                    yield flush()
        if key is not None:
            # the next partition may go on with this key
            out.extend((WAITING, *key, *row, None) for row in pending)
            out.append((SUMMARY, *key, largest, None, None, documents))
            yield flush()

    return run


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(doc_id, text_hash, position) of every line that goes; a null ``doc_id`` is ``NO_DOCUMENT``."""
    key = F.btrim(F.col("line"), F.lit(WHITE))
    lines = (
        _rows(docs, "text")
        .select("doc_id", "text_hash", F.posexplode(F.split("text", "\n")).alias("position", "line"))
        .select("doc_id", "text_hash", "position", key.alias("key"))
        .filter(F.char_length("key") >= min_chars)
        .withColumn("key", lower_ascii(F.col("key")))
        .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), F.col("key")).alias("h2"), "doc_id", "text_hash", "position")
    )
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    streamed = materialize(
        lines.repartitionByRange(partitions, "h1", "h2", F.col("doc_id").desc())
        .sortWithinPartitions("h1", "h2", F.col("doc_id").desc(), "text_hash", "position")
        .mapInArrow(releasing(_stream(min_documents)), _STREAMED)
    )
    # two summaries a partition at most, so the broadcast is bounded
    borders = (
        streamed.filter(F.col("kind") == SUMMARY)
        .groupBy("h1", "h2")
        .agg(F.sum("documents").alias("documents"), F.max("doc_id").alias("largest"))
        .filter(F.col("documents") >= min_documents)
        .select("h1", "h2", "largest")
    )
    waiting = streamed.filter(F.col("kind") == WAITING).join(F.broadcast(borders), ["h1", "h2"]).filter(F.col("doc_id") < F.col("largest"))
    rows = ["doc_id", "text_hash", "position"]
    return streamed.filter(F.col("kind") == DROPPED).select(*rows).unionByName(waiting.select(*rows))


def _rows(docs: DataFrame, *more: str) -> DataFrame:
    """The key of each row, and columns made from its text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    made = {"text": text, "n_lines": F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"))) + 1}
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_DOCUMENT))
    return docs.select(key.alias("doc_id"), F.xxhash64(text).alias("text_hash"), *[made[name].alias(name) for name in more])


def _bitmap(n_lines: pd.Series, dropped: pd.Series) -> pd.Series:
    def one(n: int, gone) -> bytes:
        keep = np.ones(n, dtype=bool)
        if gone is not None:
            keep[np.asarray(gone, dtype=np.int64)] = False
        return zlib.compress(np.packbits(keep).tobytes())

    return pd.Series([one(n, gone) for n, gone in zip(n_lines, dropped, strict=True)], dtype=object)


def read_bitmap(bitmap: bytes, n_lines: int) -> np.ndarray:
    """True for each kept line."""
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


def _kept_text(text: pd.Series, bitmap: pd.Series, n_lines: pd.Series) -> pd.Series:
    def one(t: str | None, b: bytes | None, n: int) -> str | None:
        if t is None or b is None:
            return None
        return "\n".join([line for line, keep in zip(t.split("\n"), read_bitmap(b, int(n)), strict=True) if keep])

    return pd.Series([one(t, b, n) for t, b, n in zip(text, bitmap, n_lines, strict=True)], dtype=object)


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(doc_id, text_hash, n_lines, n_dropped, bitmap), one row per distinct (doc_id, text)."""
    gone = dropped_lines(docs, min_chars, min_documents).groupBy("doc_id", "text_hash").agg(F.collect_set("position").alias("gone"))
    rows = _rows(docs, "n_lines").groupBy("doc_id", "text_hash").agg(F.first("n_lines").alias("n_lines"))
    return rows.join(gone, ["doc_id", "text_hash"], "left").select(
        "doc_id",
        "text_hash",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.pandas_udf(_bitmap, "binary")("n_lines", "gone").alias("bitmap"),
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Each row of ``docs`` as a struct ``doc``, with n_lines, n_dropped and kept_text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    left = docs.select(
        F.struct("*").alias("doc"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_DOCUMENT)).alias("left_id"),
        F.xxhash64(text).alias("left_hash"),
    )
    both = left.join(bitmaps, (F.col("left_id") == F.col("doc_id")) & (F.col("left_hash") == F.col("text_hash")))
    changed: Column = F.col("n_dropped") > 0
    # else a filter on the edited text cuts every text a second time, in a Python worker of its own
    edit = F.pandas_udf(_kept_text, "string").asNondeterministic()
    return both.select(
        "doc",
        "n_lines",
        "n_dropped",
        edit(F.when(changed, F.col("doc.text")), F.when(changed, F.col("bitmap")), F.col("n_lines")).alias("edited"),
    ).select("doc", "n_lines", "n_dropped", F.coalesce(F.when(F.col("n_dropped") > 0, F.col("edited")), F.col("doc.text"), F.lit("")).alias("kept_text"))


def query(spark, sf_dir: str) -> DataFrame:
    from duebook.llm.shared import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    applied = apply_bitmaps(docs, keep_bitmaps(docs))
    return applied.select("doc.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = """
with lines as (
  select doc_id, generate_subscripts(parts, 1) as position, unnest(parts) as line
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents)
), keyed as (
  select doc_id, position, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as line_key
  from lines
), common as (
  select line_key, max(doc_id) as largest from keyed where length(line_key) >= 40
  group by line_key having count(distinct doc_id) >= 5
), marked as (
  select k.doc_id, k.position, k.line, c.line_key is not null and k.doc_id < c.largest as gone
  from keyed k left join common c on k.line_key = c.line_key
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by position) filter (not gone), '')) as kept_sha256
from marked group by doc_id
"""
