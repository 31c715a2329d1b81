"""Language identification by Bayesian fusion of evidence.

For every language l, and for 'und' (no language known here):

    log P(l | all) = log P(text | l) + log P(declared | l) + log P(suffix | l) + log P(l | host)

The languages are those that at least ``LEAST_TEXTS`` distinct texts of the whole table declare, by a code of two or
three letters.

* ``text``: letter trigrams, hashed, without those of one repeated letter; their frequencies are fitted on at most ``SAMPLE`` labelled
  rows per language (a documented bound, chosen by hash).  Sampled texts that the trigrams found in ``COMMON`` of their
  label's texts explain no better than chance are mislabelled or noise and leave the sample.  'und' is uniform.  The mean over a text counts
  as ``EFFECTIVE`` trigrams at most, so long texts do not silence the other evidence.
* ``declared`` markup language and address ``suffix``: how often texts of l carry them, from
  grouped counts over all rows.
* ``host``: the share of l among the host's texts, smoothed by that of its domain, which
  is smoothed by the share among all texts.

All counts come from one grouped aggregation over the whole table.  Its result has one row
per (declared, suffix, domain, host), to which the documents are joined; Spark splits hot
hosts.  A document is rejected when 'und' wins or no language reaches ``MIN_POSTERIOR``.

Edge cases: a null or empty text, or one without letters or of one letter only, has no text evidence for a language
and is rejected; missing declarations, suffixes and hosts give no evidence; repeated rows are judged
alike; extra columns are kept in the struct ``doc``; with no known language all texts are 'und'.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from duebook.llm.shared import release_memory, table
from duebook.session import materialize

UNKNOWN = "und"
# codes that stand for no language
NO_LANGUAGE = (UNKNOWN, "mul", "mis", "zxx")
# a language is known if so many distinct texts declare it
LEAST_TEXTS = 5
SAMPLE = 400
SHARES = 16
BUCKETS = 1 << 13
EFFECTIVE = 60
COMMON = 0.1
STRENGTH = 5.0
MIN_POSTERIOR = 0.5

_LETTER: list[np.ndarray] = []


def trigrams(text: str | None) -> np.ndarray:
    """Hash buckets of the letter trigrams of a text, words padded by one space; a letter three times is no evidence."""
    if not text:
        return np.zeros(0, np.int64)
    if not _LETTER:
        _LETTER.append(np.array([chr(i).isalpha() for i in range(0x10000)]))
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    letter = _LETTER[0][np.minimum(points, 0xFFFF)] | (points > 0xFFFF)
    points = np.where(letter, points, 32)
    middle = letter[1:-1] & ~((points[:-2] == points[1:-1]) & (points[1:-1] == points[2:]))
    mixed = (points[:-2] * 0x9E37 + points[1:-1]) * 0x85EB + points[2:]
    return ((mixed ^ (mixed >> 15)) & (BUCKETS - 1))[middle]


def declared_languages(docs: DataFrame, least: int = LEAST_TEXTS) -> list[str]:
    """Codes that at least ``least`` distinct texts declare; there are fewer than 27^3 codes of three letters."""
    coded = docs.filter(F.col("declared").rlike("^[a-z]{2,3}$") & ~F.col("declared").isin(*NO_LANGUAGE) & (F.char_length("text") > 0))
    counts = coded.select("declared", F.xxhash64("text").alias("key")).distinct().groupBy("declared").count()
    return sorted(r["declared"] for r in counts.filter(F.col("count") >= least).select("declared").collect())


def fit(docs: DataFrame, languages: list[str], sample: int = SAMPLE) -> np.ndarray:
    """log P(bucket | language), one row per language and a last one for 'und'."""
    named = F.col("declared").isin(*languages) if languages else F.lit(False)
    labelled = docs.filter(named & F.col("text").isNotNull())
    order = F.xxhash64("text")
    ranked = labelled.select("declared", order.alias("key")).distinct()
    # a hot language is ranked in ``SHARES`` first, so the last task of it reads at most SHARES x sample rows
    for groups in (["declared", F.pmod("key", F.lit(SHARES))], ["declared"]):
        rank = F.row_number().over(Window.partitionBy(*groups).orderBy("key"))
        ranked = ranked.withColumn("rank", rank).filter(F.col("rank") <= sample).drop("rank")
    keys = [r["key"] for r in ranked.select("key").collect()]
    # one row for each of the ``sample`` texts, however often a text is repeated
    chosen = materialize(
        labelled.select("declared", "text", order.alias("key"))
        .filter(F.col("key").isin(keys) if keys else F.lit(False))
        .groupBy("declared", "key")
        .agg(F.min("text").alias("text"))
    )
    common = _log_shares(_bucket_counts(chosen), languages, COMMON)

    def ordinary(declared: pd.Series, texts: pd.Series) -> pd.Series:
        """Texts that the common trigrams of their label explain better than chance does."""
        scores = [text_scores(t, common) for t in texts]
        return pd.Series([s[languages.index(d)] > s[-1] for d, s in zip(declared, scores, strict=True)], dtype=bool)

    # stored, so that no task keeps a Python worker for this filter and one for the buckets
    return _log_shares(_bucket_counts(materialize(chosen.filter(F.pandas_udf(ordinary, "boolean")("declared", "text")))), languages)


def _bucket_counts(chosen: DataFrame) -> list[Row]:
    """(declared, bucket, n, share of the label's texts): at most languages x buckets rows."""
    to_buckets = F.pandas_udf(lambda texts: texts.map(trigrams, na_action=None), "array<long>")
    texts = chosen.groupBy("declared").agg(F.count("*").alias("n_texts"))
    each = chosen.select("declared", "key", F.explode(to_buckets("text")).alias("bucket")).groupBy("declared", "key", "bucket").count()
    counts = each.groupBy("declared", "bucket").agg(F.sum("count").alias("n"), F.count("*").alias("n_holding"))
    return counts.join(texts, "declared").select("declared", "bucket", "n", (F.col("n_holding") / F.col("n_texts")).alias("share")).collect()


def _log_shares(counts: list[Row], languages, least_share: float = 0.0) -> np.ndarray:
    """Logarithms of smoothed shares of the buckets that ``least_share`` of a label's texts hold."""
    table_ = np.full((len(languages) + 1, BUCKETS), 0.1)
    table_[-1] = 1.0
    for row in counts:
        if row["share"] >= least_share:
            table_[languages.index(row["declared"]), row["bucket"]] += row["n"]
    # a language without a labelled row is as unknown as 'und', and less likely
    return np.log(table_ / table_.sum(axis=1, keepdims=True)) - (table_.sum(axis=1, keepdims=True) < BUCKETS * 0.1 + 0.5)


def text_scores(text: str | None, weights: np.ndarray) -> list[float]:
    """log P(text | l) of each language, 'und' last."""
    buckets = trigrams(text)
    n = len(buckets)
    if not n:
        return [0.0] * len(weights)
    counts = np.bincount(buckets, minlength=BUCKETS)
    return (weights @ counts * (min(n, EFFECTIVE) / n)).tolist()


def _evidence_of(url: Column) -> tuple[Column, Column, Column]:
    """(suffix, domain, host) of an address or a bare host name."""
    host = F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?([^/?#:]+)", 1))
    known = F.when(host != "", host)
    dotted = known.contains(".")
    return F.when(dotted, F.substring_index(known, ".", -1)), F.when(dotted, F.substring_index(known, ".", -2)), known


def _add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def identify(docs: DataFrame, text: Column, declared: Column, url: Column, languages: list[str] | None = None, min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """Each row of ``docs`` as a struct ``doc``, with language, posterior, text_language and kept."""
    spark = docs.sparkSession
    suffix, domain, host = _evidence_of(url)
    primary = F.lower(F.substring_index(F.trim(declared), "-", 1))
    rows = docs.select(
        F.struct("*").alias("doc"),
        text.alias("text"),
        F.when(primary != "", primary).alias("declared"),
        suffix.alias("suffix"),
        domain.alias("domain"),
        host.alias("host"),
    )
    languages = declared_languages(rows) if languages is None else list(languages)
    classes = [*languages, UNKNOWN]
    # languages x buckets numbers, whatever the corpus
    weights = spark.sparkContext.broadcast(fit(rows, languages))

    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield texts.map(lambda t: text_scores(t, weights.value), na_action=None)
        release_memory()

    scored = rows.withColumn("scores", F.pandas_udf(score, "array<double>")("text"))
    keys = ["declared", "suffix", "domain", "host"]
    best = F.array_max("scores")
    # among equal scores the unknown class comes first, then the order of the languages
    won = F.when(F.element_at("scores", -1) >= best, F.lit(len(classes))).otherwise(F.array_position("scores", best).cast("int"))
    counts = materialize(scored.withColumn("won", won).groupBy(*keys, "won").agg(F.count("*").alias("n")))
    evidence = _evidence(counts, keys, len(classes))

    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"e.{k}")) for k in keys]
    joined = scored.alias("s").join(evidence.alias("e"), same[0] & same[1] & same[2] & same[3], "left")
    total = joined.select("s.doc", won_text(F.col("s.scores"), classes).alias("text_language"), _add(F.col("s.scores"), F.col("e.evidence")).alias("total"))
    top = F.array_max("total")
    share = 1 / F.aggregate("total", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    winner = F.when(F.element_at("total", -1) >= top, F.lit(UNKNOWN)).otherwise(
        F.element_at(F.array(*[F.lit(c) for c in classes]), F.array_position("total", top).cast("int"))
    )
    # without any letter the text says nothing, and only then are all its scores zero
    judged = total.select("doc", "text_language", winner.alias("language"), F.round(share, 6).alias("posterior"))
    kept = (F.col("language") != UNKNOWN) & (F.col("posterior") >= min_posterior) & (F.col("text_language") != UNKNOWN)
    return judged.withColumn("kept", kept)


def won_text(scores: Column, classes: list[str]) -> Column:
    """The language the text alone speaks for."""
    best = F.array_max(scores)
    named = F.element_at(F.array(*[F.lit(c) for c in classes]), F.array_position(scores, best).cast("int"))
    return F.when(F.element_at(scores, -1) >= best, F.lit(UNKNOWN)).otherwise(named)


def _evidence(counts: DataFrame, keys: list[str], n_classes: int) -> DataFrame:
    """(keys, evidence): the sum of the three logarithms for each class."""
    per_class = [F.sum(F.when(F.col("won") == i + 1, F.col("n")).otherwise(0)).cast("double").alias(f"c{i}") for i in range(n_classes)]

    def grouped(key: str) -> DataFrame:
        return counts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.array(*per_class).alias(f"{key}_counts"))

    everything = counts.agg(F.array(*per_class).alias("all_counts")).first()["all_counts"]
    totals = F.array(*[F.lit(float(n or 0)) for n in everything])
    combos = counts.select(*keys).distinct().withColumn("all_counts", totals)
    for key in keys:
        values = grouped(key).withColumnRenamed(key, f"{key}_value")
        combos = combos.join(values, F.col(key) == F.col(f"{key}_value"), "left").drop(f"{key}_value")

    def smooth(own: Column, parent: Column) -> Column:
        """(n_l + strength * parent_l) / (n + strength), or the parent where nothing is known."""
        n = F.aggregate(own, F.lit(0.0), lambda a, x: a + x)
        return F.coalesce(F.zip_with(own, parent, lambda x, p: (x + STRENGTH * p) / (n + STRENGTH)), parent)

    def likelihood(own: Column) -> Column:
        """log P(value | l) from the counts of the value and of l among all texts."""
        return F.coalesce(
            F.zip_with(own, F.col("all_counts"), lambda x, t: F.log((x + 0.5) / (t + 1.0))), F.array(*[F.lit(0.0)] * n_classes)
        )

    flat = F.array(*[F.lit(1.0 / n_classes)] * n_classes)
    staged = combos.withColumn("all_share", smooth(F.col("all_counts"), flat))
    staged = staged.withColumn("domain_share", smooth(F.col("domain_counts"), F.col("all_share")))
    staged = staged.withColumn("host_share", smooth(F.col("host_counts"), F.col("domain_share")))
    prior = F.transform("host_share", lambda p: F.log(p))
    return staged.select(*keys, _add(_add(prior, likelihood(F.col("declared_counts"))), likelihood(F.col("suffix_counts"))).alias("evidence"))


def of_documents(docs: DataFrame) -> DataFrame:
    """The documents table: its ``lang`` is the declared language, its ``source`` the host."""
    return identify(docs, F.col("text"), F.col("lang"), F.col("source"))


def of_pages(pages: DataFrame) -> DataFrame:
    """Web pages: the declared language stands in the html element, the text is the main text."""
    from duebook.llm.html_text import extract

    declared = F.regexp_extract("html", r"(?i)<html[^>]*\slang=[\"']?([a-zA-Z-]+)", 1)
    return identify(pages, extract(F.col("html")), declared, F.col("url"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = of_documents(table(spark, sf_dir, "documents"))
    return found.select("doc.doc_id", F.col("doc.lang").alias("declared"), "text_language", "language", "posterior", "kept")


def query_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = of_pages(table(spark, sf_dir, "pages"))
    return found.select("doc.page_id", "doc.url", "text_language", "language", "posterior", "kept")


SQL = None
