"""Phrase counts and collocations against a plain count of all phrases."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from duebook.llm import collocations
from duebook.llm.shared import ship

SCHEMA = "doc_id long, text string, lang string, phrase string, f string, k string"


@pytest.fixture(scope="module")
def shipped(spark):
    ship(spark)
    return spark


def plain_counts(rows):
    """{lang: Counter of phrases as tuples}; the empty tuple counts all words."""
    counts = defaultdict(Counter)
    for text, lang in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            for i in range(len(words)):
                counts["und" if lang is None else lang][()] += 1
                for k in range(1, 5):
                    if i + k <= len(words):
                        counts["und" if lang is None else lang][tuple(words[i : i + k])] += 1
    return counts


def plain_rows(rows, least, top):
    out = []
    for lang, f in plain_counts(rows).items():
        candidates = {p: a for p, a in f.items() if 2 <= len(p) and a >= least}
        kept = []
        for p, a in candidates.items():
            covered = any(
                100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in candidates.items() if len(q) > len(p)
            )
            if not covered:
                score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, f[()], -score))
    return sorted(out)


def made_rows(n, seed):
    r = random.Random(seed)
    words = ["The", "cat", "sat", "é", "ß#", "\x0e", "down", "Down", "dog", "𝔘ni", "~"]
    gaps = [" "] * 8 + ["  ", "\t", ", ", ".", "\n", " ; ", "\r\n", "\x0b"]
    rows = [(None, "en"), ("", None), (" \t\n", "en"), ("one", None), ("...", "de")]
    for i in range(n):
        text = "".join(r.choice(words) + r.choice(gaps) for _ in range(r.randint(0, 60)))
        rows.append((text, r.choice(["en", "en", "de", None, "zz"])))
    return rows


def test_collocations_equal_a_plain_count(shipped):
    rows = made_rows(150, 1)
    docs = shipped.createDataFrame([(i, t, lang, "x", "y", "z") for i, (t, lang) in enumerate(rows)] + [(None, "null id null id", "en", "", "", "")], SCHEMA)
    rows.append(("null id null id", "en"))
    for least, top in ((5, 2000), (12, 7)):
        got = collocations.collocations(docs.repartition(3), least, top).collect()
        assert sorted(map(tuple, got)) == plain_rows(rows, least, top)
    assert collocations.collocations(docs.limit(0)).collect() == []
    assert collocations.collocations(docs.filter("text = ''")).collect() == []


@pytest.mark.parametrize("held, burst, words, step", [(40, 5, 30, 25), (100, 1, 8, 7), (10**6, 10**6, 10**6, 10**6)])
def test_spilled_runs_lose_nothing(monkeypatch, held, burst, words, step):
    """Small limits, ranges inside of a word's windows, and several tasks give the same counts."""
    for name, value in (("HELD", held), ("BURST", burst), ("WORDS", words), ("STEP", step), ("BATCH_BYTES", 500)):
        monkeypatch.setattr(collocations, name, value)
    rows = made_rows(60, 2)
    borders = sorted({("de", "the", "", "", ""), ("en", "cat", "cat", "", ""), ("en", "cat", "missing", "dog", ""), ("en", "the", "cat", "sat", "down"), ("und", "", "", "", "")})
    found = []
    for part in (rows[::2], rows[1::2]):
        batch = pa.RecordBatch.from_arrays([pa.array([lang or "und" for _, lang in part]), pa.array([t for t, _ in part])], names=["lang", "text"])
        for out in collocations._count(borders, 4)(iter([batch])):
            found += zip(*[out.column(i).to_pylist() for i in range(6)], strict=True)
    if held < 1000:
        assert len(found) > 40
    got = Counter()
    for task in range(4):
        own = sorted((row for row in found if row[0] == task), key=lambda row: (row[1], row[2]))
        if own:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*own, strict=True), collocations._RUN_ARROW.types, strict=True)], schema=collocations._RUN_ARROW)
            for out in collocations._merge(6, borders)(iter([batch])):
                for lang, _, phrase, f in zip(*[out.column(i).to_pylist() for i in range(4)], strict=True):
                    got[lang, tuple(phrase.split(" ")) if phrase else ()] += f
    plain = {(lang, p): n for lang, f in plain_counts(rows).items() for p, n in f.items()}
    assert {key: n for key, n in got.items() if n >= 6 or not key[1]} == {key: n for key, n in plain.items() if n >= 6 or not key[1]}


def test_large_numbers_stay_exact(shipped):
    """Counts beyond 32 bits pass through the packed runs, and the score's product beyond 64 bits is exact."""
    import numpy as np

    counts = np.array([1, 2**31, 2**33 + 5, 3], np.int64)
    columns = [np.arange(4), np.zeros(4, np.int64), np.arange(4), np.arange(4)]
    data = collocations.Run._sized(columns, counts)
    back, n = collocations._unpack(4, data[8:], int.from_bytes(data[:8], "little"))
    assert n.tolist() == counts.tolist() and back[2].tolist() == [0, 1, 2, 3]
    a, other = 9 * 10**15, 9 * 10**15 + 7
    row = shipped.sql(f"select (cast({a}L as decimal(38, 0)) * 2000000) div ({a}L + {other}L) as score").first()
    assert row["score"] == 2_000_000 * a // (a + other)
