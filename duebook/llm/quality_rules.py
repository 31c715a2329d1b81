"""Quality rules: base counts of a text, and lines that many documents of a host share.

Only DataFrame functions are used.  The rule: lines are normalised (trimmed, lower-cased) and hashed; a
line found in more than ``max(min_documents, min(max_documents, share * documents))`` distinct
documents of its host is removed, where documents with equal texts count once: exact copies say
nothing about a line, as all lines of a text that is copied often would go; a document that loses
more than ``max_removed`` of its characters is rejected.  Counting is a grouped aggregation with
map-side sums, and only the (host, line) pairs above the limit meet the documents again.

Edge cases: a null or empty text has no words and fails the base rule; a null host is the host
''; repeated rows get equal results; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.llm.shared import WHITE, table

MIN_DOCUMENTS = 20
MAX_DOCUMENTS = 1000
SHARE = 0.05
MAX_REMOVED = 0.7
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
REPEAT_WINDOW = 5

_SPACES = "[ \\t-\\r]+"
SYMBOLS = "#*$%&|<>"


def _lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), _has_words)


def _has_words(line: Column) -> Column:
    return F.btrim(line, F.lit(WHITE)) != ""


def _line_hash(line: Column) -> Column:
    return F.xxhash64(F.lower(F.btrim(line, F.lit(WHITE))))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.coalesce(F.col("source"), F.lit("")).alias("host"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def base_counts(docs: DataFrame) -> DataFrame:
    """Counts of each text.  Each step is a column of its own, so that no lambda evaluates one again."""
    words = F.array_remove(F.split("text", _SPACES), "")
    n = REPEAT_WINDOW
    split = _keyed(docs).withColumn("words", words).withColumn("lines", _lines_with_words(F.col("text")))
    n_windows = F.size("words") - n + 1
    window = F.transform(
        F.sequence(F.lit(0), n_windows - 1), lambda i: F.xxhash64(*[F.get(F.col("words"), i + k) for k in range(n)])
    )
    counted = split.select(
        "doc_id",
        "host",
        "text_hash",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.char_length("text").alias("n_chars"),
        "text",
        F.when(n_windows > 1, window).otherwise(F.array().cast("array<long>")).alias("windows"),
    )
    # most texts repeat no window and need no sort
    numbered = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = counted.withColumn("ordered", F.when(repeats, numbered)).drop("windows")
    twice = F.filter(
        F.col("ordered"),
        lambda e, k: F.coalesce(e.h == F.get(F.col("ordered"), k - 1).h, F.lit(False))
        | F.coalesce(e.h == F.get(F.col("ordered"), k + 1).h, F.lit(False)),
    )
    places = ordered.withColumn("places", F.array_sort(F.transform(twice, lambda e: e.i))).drop("ordered")
    start = F.struct(F.lit(0).alias("total"), F.lit(-n).alias("last"))
    covered = F.aggregate(
        "places",
        start,
        lambda state, at: F.struct((state.total + F.least(F.lit(n), at - state["last"])).alias("total"), at.alias("last")),
        lambda state: state.total,
    )
    counts = places.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("places")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return counts.withColumn("base_failed", failed)


def common_lines(
    docs: DataFrame, min_documents: int = MIN_DOCUMENTS, share: float = SHARE, max_documents: int = MAX_DOCUMENTS
) -> DataFrame:
    """(host, line) of the lines above the limit, lines as hashes."""
    keyed = _keyed(docs)
    lines = F.array_distinct(F.transform(_lines_with_words(F.col("text")), _line_hash))
    found = keyed.select("host", "text_hash", F.explode(lines).alias("line"))
    often = found.groupBy("host", "line").agg(F.count_distinct("text_hash").alias("n")).filter(F.col("n") > min_documents)
    hosts = keyed.groupBy("host").agg(F.count_distinct("text_hash").alias("documents"))
    above = (F.col("n") > max_documents) | (F.col("n") > share * F.col("documents"))
    return often.join(hosts, "host").filter(above).select("host", "line")


def removed_chars(docs: DataFrame, common: DataFrame) -> DataFrame:
    """(doc_id, host, text_hash, removed, places): characters and places of common lines in each document."""
    parts = F.transform(
        F.split("text", "\n"), lambda line, i: F.struct(i.alias("place"), _line_hash(line).alias("line"), F.char_length(line).alias("size"), _has_words(line).alias("full"))
    )
    lines = F.filter(parts, lambda part: part.full)
    rows = _keyed(docs).select("doc_id", "host", "text_hash", F.explode(lines).alias("part"))
    hit = rows.select("doc_id", "host", "text_hash", "part.place", "part.line", "part.size").join(common, ["host", "line"])
    # repeated rows of a document have the same places
    once = hit.groupBy("doc_id", "host", "text_hash", "place").agg(F.max("size").alias("size"))
    return once.groupBy("doc_id", "host", "text_hash").agg(F.sum("size").alias("removed"), F.collect_list("place").alias("places"))


def apply_rules(
    docs: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    share: float = SHARE,
    max_removed: float = MAX_REMOVED,
    max_documents: int = MAX_DOCUMENTS,
) -> DataFrame:
    """Base counts, removed characters, the verdict and the text without its common lines of each document."""
    base = base_counts(docs).alias("b")
    removed = removed_chars(docs, common_lines(docs, min_documents, share, max_documents)).alias("r")
    same = F.col("b.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("b.host") == F.col("r.host")) & (F.col("b.text_hash") == F.col("r.text_hash"))
    gone = F.coalesce(F.col("r.removed"), F.lit(0))
    # two uses keep the lines a column of their own
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "r.places"), lambda i: F.get(F.col("lines"), i))
    return base.join(removed, same, "left").withColumn("lines", F.split("b.text", "\n")).select(
        "b.doc_id",
        *[f"b.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")],
        gone.alias("removed_chars"),
        (~F.col("b.base_failed") & (gone <= max_removed * F.col("b.n_chars"))).alias("kept"),
        F.when(F.col("r.places").isNull(), F.col("b.text")).otherwise(F.array_join(left, "\n")).alias("clean_text"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents")).drop("clean_text")


SQL = r"""
with docs as (select doc_id, coalesce(source, '') as host, coalesce(text, '') as text from documents),
words as (
  select doc_id, text, regexp_extract_all(text, '[^ \t-\r]+') as words from docs
), windows as (
  select doc_id, i, array_to_string(words[i : i + 4], chr(10)) as part
  from (select doc_id, words, unnest(range(1, len(words) - 3)) as i from words where len(words) >= 5)
), repeats as (
  select doc_id, i from windows qualify count(*) over (partition by doc_id, part) > 1
), covered as (
  select doc_id, count(distinct j) as n from (select doc_id, unnest(range(i, i + 5)) as j from repeats) group by doc_id
), lines as (
  select doc_id, host, line, lower(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) as norm
  from (select doc_id, host, unnest(string_split(text, chr(10))) as line from docs)
), full_lines as (select * from lines where norm <> ''),
dup_lines as (select doc_id, count(*) - count(distinct line) as n from full_lines group by doc_id),
hosts as (select host, count(distinct text) as documents from docs group by host),
common as (
  select l.host, l.norm from full_lines l join docs d on l.doc_id = d.doc_id join hosts h on l.host = h.host
  group by l.host, l.norm, h.documents
  having count(distinct d.text) > 20 and (count(distinct d.text) > 1000 or count(distinct d.text) > 0.05 * h.documents)
), removed as (
  select doc_id, sum(length(line)) as n from full_lines semi join common on full_lines.host = common.host and full_lines.norm = common.norm
  group by doc_id
), base as (
  select w.doc_id, len(w.words)::bigint as n_words, length(array_to_string(w.words, ''))::bigint as word_chars,
    (length(w.text) - length(translate(w.text, '#*$%&|<>', '')))::bigint as n_symbols, coalesce(d.n, 0) as n_dup_lines,
    coalesce(c.n, 0) as n_repeat_words, coalesce(r.n, 0)::bigint as removed_chars, length(w.text) as n_chars
  from words w left join dup_lines d using (doc_id) left join covered c using (doc_id) left join removed r using (doc_id)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed, removed_chars,
  not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and removed_chars <= 0.7 * n_chars as kept
from base
"""
