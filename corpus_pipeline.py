"""From the documents table to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on every row that the stage before kept, and is
written and read again before the next.  All but the last return the columns of ``documents``.

Edge cases, the same in every stage: a null or empty text is rejected by the first stage; a null ``doc_id`` stays a
document of its own until the near duplicates, where equal rows become one; repeated rows are one document there, and
equal ones before; a text of any length is worked on whole; extra columns, also ones named like those of an operator,
pass through all stages but the last; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.llm import decontaminate, language_id, line_dedup, ngram_join, packing
from duebook.llm.queries import with_package
from duebook.llm.shared import table
from duebook.session import discard, materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language."""
    return language_id.of_documents(docs).filter("kept").select("doc.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; one that lost lines and has no word left goes."""
    applied = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    changed = F.col("n_dropped") > 0
    left = applied.filter(~changed | (F.btrim("kept_text", F.lit(line_dedup.WHITE)) != ""))
    edits = {
        "text": F.when(changed, F.col("kept_text")).otherwise(F.col("doc.text")),
        "n_chars": F.when(changed, F.char_length("kept_text").cast("long")).otherwise(F.col("doc.n_chars")),
    }
    return left.select(*[edits.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents."""
    return ngram_join.one_of_each_group(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).filter("n_hit = 0").select("doc.*")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their places in training sequences."""
    return packing.packed(docs)


STAGES = [
    ("language_id", with_package(language)),
    ("line_dedup", with_package(lines)),
    ("ngram_join", with_package(near_duplicates)),
    ("decontamination", with_package(benchmark)),
    ("packing", with_package(sequences)),
]

# tokens and trigram models are beyond SQL; tests/llm holds the rows against a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
