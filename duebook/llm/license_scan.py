"""Licence scans: base phrases, and an exact containment join of text blocks with templates.

Only DataFrame functions are used.  A block is a line, or a run of as many consecutive words as
the template has, across line breaks, so that wrapped notices are found; a template is found in a
block that holds at least ``THRESHOLD`` of the template's distinct words.  The words of all templates
are ordered by the number of documents that hold them, rarest first; that count and
the order have as many entries as the templates have words.  A block can reach the needed overlap only if it

* holds a word of the template's prefix, its ``size - needed + 1`` rarest words,
* has ``needed`` template words at all (length), and
* has ``needed`` words left from its first common word on (position).

A run that reaches it can be moved to begin with a word of the template; only such runs are tested.

Blocks that pass are verified by their whole overlap, so the join is exact.  Documents without any prefix
word, nearly all, stop at the first test.

Edge cases: a null or empty text has no words, no label and score 0; repeated rows get equal
results; extra columns are ignored.  The score is 1 where a base phrase stands, else the largest
containment found.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.llm.shared import lower_ascii, table

THRESHOLD = 0.8

# fixed values: base phrases and their labels
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# fixed values: openings and notices of public licences
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]

_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(lowered: Column) -> Column:
    return F.array_remove(F.split(lowered, _GAP), "")


def _texts(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def template_words(text: str) -> list[str]:
    """Distinct words of a template, sorted."""
    return sorted(set(re.findall("[0-9a-z]+", text.lower())))


def word_order(docs: DataFrame, templates=TEMPLATES) -> list[str]:
    """All template words, those in the fewest documents first, ties by the word."""
    vocabulary = sorted({w for _, text in templates for w in template_words(text)})
    lowered = lower_ascii(F.coalesce(F.col("text"), F.lit("")))
    found = docs.select(F.explode(F.array_intersect(_words(lowered), _texts(vocabulary))).alias("word"))
    counts = {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Base places, labels and score of each document."""
    order = word_order(docs, templates)
    rank = {w: i + 1 for i, w in enumerate(order)}
    prepared = []
    for label, text in templates:
        ranks = sorted(rank[w] for w in template_words(text))
        needed = math.ceil(threshold * len(ranks))
        length = len(re.findall("[0-9a-z]+", text.lower()))
        prepared.append((label, ranks, needed, ranks[: len(ranks) - needed + 1], length))
    first = sorted({order[r - 1] for _, _, _, prefix, _ in prepared for r in prefix} | {p.split()[-1] for p, _ in PHRASES})

    lowered = docs.select("doc_id", lower_ascii(F.coalesce(F.col("text"), F.lit(""))).alias("text"))
    words = lowered.withColumn("words", _words(F.col("text")))
    tested = words.withColumn("candidate", F.arrays_overlap("words", _texts(first)))

    def ranked(ranks: list[int]) -> Callable[[Column], Column]:
        return lambda x: x["rank"].isin(ranks)

    def places(phrase: str, label: str) -> Column:
        parts = phrase.split()

        def here(i: Column) -> Column:
            test = F.get(F.col("words"), i) == parts[0]
            for k, part in enumerate(parts[1:], 1):
                test &= F.get(F.col("words"), i + k) == part
            return F.coalesce(test, F.lit(False))

        starts = F.filter(F.sequence(F.lit(0), F.size("words") - 1), here)
        return F.transform(starts, lambda i: F.struct(i.cast("long").alias("at"), F.lit(label).alias("label")))

    # the ranks of the template words in each block, in order
    def ranks_of(line: Column) -> Column:
        known = F.array_intersect(_words(line), _texts(order))
        return F.array_sort(F.transform(known, lambda w: F.array_position(_texts(order), w)))

    blocks = F.transform(F.split("text", "\n"), ranks_of)
    base = F.concat(*[places(*p) for p in PHRASES])
    found = tested.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.when(F.col("candidate"), base).alias("base"),
        F.when(F.col("candidate"), F.filter(blocks, lambda b: F.size(b) > 0)).alias("blocks"),
        F.when(F.col("candidate"), F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at")))).alias("placed"),
    )
    # places and ranks of the template words in the whole text
    known = F.filter("placed", lambda x: x.word.isin(order))
    found = found.withColumn("known", F.transform(known, lambda x: F.struct(x["at"].alias("at"), F.array_position(_texts(order), x.word).alias("rank"))))
    found = found.drop("placed")
    # each step is a column of its own, so that no lambda evaluates one again
    for k, (_, ranks, _, prefix, _) in enumerate(prepared):
        found = found.withColumn(f"own{k}", F.when(F.exists("known", ranked(prefix)), F.filter("known", ranked(ranks))))

    def most_of_runs(own: Column, needed: int, length: int) -> Column:
        def overlap(x: Column, i: Column) -> Column:
            # at most ``length`` places lie in a run
            run = F.filter(F.slice(own, i + 1, length), lambda y: y["at"] < x["at"] + length)
            distinct = F.size(F.array_distinct(F.transform(run, lambda y: y["rank"])))
            return F.when(F.get(own, i + (needed - 1))["at"] < x["at"] + length, distinct).otherwise(0)

        return F.coalesce(F.array_max(F.transform(own, overlap)), F.lit(0))

    def containment(k: int, ranks: list[int], needed: int, prefix: list[int], length: int) -> Column:
        own, front = F.array(*[F.lit(r).cast("long") for r in ranks]), F.array(*[F.lit(r).cast("long") for r in prefix])

        def possible(block: Column) -> Column:
            left = F.size(block) - F.array_position(block, F.element_at(F.array_intersect(block, own), 1)) + 1
            return (F.size(block) >= needed) & F.arrays_overlap(block, front) & (left >= needed)

        overlaps = F.transform(F.filter("blocks", possible), lambda b: F.size(F.array_intersect(b, own)))
        most = F.greatest(F.coalesce(F.array_max(overlaps), F.lit(0)), most_of_runs(F.col(f"own{k}"), needed, length))
        return F.when(most >= needed, most / F.lit(float(len(ranks)))).otherwise(F.lit(0.0))

    scores = F.array(*[F.struct(containment(k, *rest).alias("score"), F.lit(label).alias("label")) for k, (label, *rest) in enumerate(prepared)])
    scored = found.withColumn("matches", F.when(F.size("blocks") > 0, F.filter(scores, lambda m: m.score > 0)))

    base_labels = F.array_distinct(F.transform("base", lambda p: p.label))
    all_labels = F.array_union(base_labels, F.coalesce(F.transform("matches", lambda m: m.label), F.array().cast("array<string>")))
    text_of = lambda labels: F.coalesce(F.array_join(F.array_sort(labels), ","), F.lit(""))
    n_base = F.coalesce(F.size("base"), F.lit(0))
    n_base = F.greatest(n_base, F.lit(0)).cast("long")
    return scored.select(
        "doc_id",
        "n_words",
        n_base.alias("n_base"),
        F.array_min(F.transform("base", lambda p: p["at"])).alias("first_word"),
        F.array_max(F.transform("base", lambda p: p["at"])).alias("last_word"),
        text_of(base_labels).alias("base_labels"),
        text_of(all_labels).alias("labels"),
        F.when(n_base > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("matches", lambda m: m.score)), F.lit(0.0))).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _template_rows() -> str:
    rows = [(k, label, word) for k, (label, text) in enumerate(TEMPLATES) for word in template_words(text)]
    return ", ".join(f"({k}, '{label}', '{word}')" for k, label, word in rows)


SQL = rf"""
with docs as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents
), words as (
  select doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from docs
), numbered as (
  select doc_id, i, words[i + 1] as a, words[i + 2] as b, words[i + 3] as c
  from (select doc_id, words, unnest(range(0, len(words))) as i from words)
), places as (
  select doc_id, i, case when a = 'general' then 'gpl' else a end as label from numbered
  where (a in ('mit', 'apache') and b = 'license') or (a = 'general' and b = 'public' and c = 'license')
), base as (
  select doc_id, count(*) as n, min(i) as lo, max(i) as hi from places group by doc_id
), template(k, label, word) as (values {_template_rows()}),
sizes as (select k, label, count(*) as size from template group by k, label),
block_words as (
  select distinct doc_id, block, unnest(regexp_extract_all(line, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word
  from (select doc_id, generate_subscripts(lines, 1) as block, unnest(lines) as line
    from (select doc_id, string_split(text, chr(10)) as lines from docs))
), shared as (
  select b.doc_id, b.block, t.k, count(*) as n from block_words b join template t on b.word = t.word group by all
), matches as (
  select o.doc_id, s.label, o.n / s.size::double as score from shared o join sizes s using (k) where o.n >= ceil({THRESHOLD} * s.size)
), labels as (
  select doc_id, string_agg(distinct label, ',' order by label) as labels
  from (select doc_id, label from matches union all select doc_id, label from places) group by doc_id
), base_labels as (
  select doc_id, string_agg(distinct label, ',' order by label) as labels from places group by doc_id
), best as (select doc_id, max(score) as score from matches group by doc_id)
select w.doc_id, len(w.words)::bigint as n_words, coalesce(b.n, 0) as n_base, b.lo as first_word, b.hi as last_word,
  coalesce(bl.labels, '') as base_labels, coalesce(l.labels, '') as labels,
  case when coalesce(b.n, 0) > 0 then 1.0::double else coalesce(s.score, 0.0::double) end as score
from words w left join base b using (doc_id) left join base_labels bl using (doc_id) left join labels l using (doc_id)
left join best s using (doc_id)
"""
