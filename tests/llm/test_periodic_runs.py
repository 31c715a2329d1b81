"""Runs of repeated words against a plain search of all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from duebook.llm import periodic_runs
from duebook.llm.shared import ship

SCHEMA = "doc_id long, text string, lang string, runs string, start string"


@pytest.fixture(scope="module")
def shipped(spark):
    ship(spark)
    return spark


def plain_runs(words):
    """(start, length, period) of all runs, by comparing the words at every distance."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            smaller = any(all(words[start + k] == words[start + k + d] for k in range(length - d)) for d in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text, shaped=True):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if shaped and doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    best = (None,) * 4
    if runs:
        # a common multiple of the periods compares exponents without fractions
        top = max(runs, key=lambda r: (r[1] * np.prod([x[2] for x in runs], dtype=object) // r[2], -r[0], -r[2]))
        best = (*top, 1000 * top[1] // top[2])
    return (doc_id, len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_runs_equal_a_plain_search():
    r = random.Random(3)
    for _ in range(400):
        texts = []
        for _ in range(r.randint(0, 5)):
            n, letters = r.randint(0, 70), r.choice([1, 2, 3, 40])
            words = [r.randrange(letters) for _ in range(n)]
            for _ in range(r.randint(0, 3) if n else 0):
                a = r.randrange(n)
                p = 1 + r.randrange(max(1, (n - a) // 3 + 1))
                for i in range(a, min(n, a + p * r.randint(3, 9))):
                    words[i] = words[a + (i - a) % p]
            texts.append(words)
        lengths = np.array([len(w) for w in texts], np.int64)
        ids = np.array([w for words in texts for w in words], np.int64)
        got = sorted(periodic_runs.runs_of(ids, np.cumsum(lengths) - lengths, lengths), key=lambda x: (x[0], x[1], x[3]))
        assert got == [(k, *run) for k, words in enumerate(texts) for run in plain_runs(words)]


def test_long_texts_take_no_quadratic_time():
    fibonacci, longer = [0], [0, 1]
    while len(longer) < 50_000:
        fibonacci, longer = longer, longer + fibonacci
    for words, runs in (([7] * 50_000, [(0, 0, 50_000, 1)]), ([i % 999 for i in range(50_000)], [(0, 0, 50_000, 999)]), (longer, [])):
        assert periodic_runs.runs_of(np.array(words), np.array([0]), np.array([len(words)])) == runs


def test_query_columns(shipped):
    r = random.Random(9)
    tenths = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    texts = ["", None, " \t\n", "a", "a a a a a a", " x \x1c  x", "one two one two one two one two", "b b b b b\x0bb\x0cb\rb é é é é é é"]
    rows = [(i, r.choice(texts), "en", "x", "y") for i in range(60)]
    rows += [(i, " ".join(r.choice("ab cd ef gh".split()) for _ in range(r.randint(1, 120))), None, "x", "y") for i in tenths]
    rows += [(None, "n n n n n n n n", "en", "x", "y"), (5, "same row", "en", "x", "y"), (5, "same row", "en", "x", "y"), (-3, "z " * 40, "en", "", "")]
    docs = shipped.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(map(str, map(tuple, periodic_runs.detect(docs, shaped=True, with_text=False).collect())))
    assert got == sorted(str(plain_row(doc_id, text)) for doc_id, text, *_ in rows)


def test_texts_and_runs_of_the_operator(shipped):
    docs = shipped.createDataFrame([(1, "x go on go on go on go on y", "en", "", ""), (2, None, "en", "", "")], SCHEMA)
    one, two = sorted(periodic_runs.detect(docs).collect(), key=lambda row: row["doc_id"])
    assert one["collapsed"] == "x go on y" and [tuple(run) for run in one["runs"]] == [(1, 8, 2)]
    assert two["collapsed"] == "" and two["runs"] == []
    assert periodic_runs.detect(docs.limit(0)).collect() == []


def test_query_on_the_given_documents(shipped):
    folder = "/root/testdata/sf0.001"
    docs = shipped.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    short = [(d["doc_id"], d["text"]) for d in docs if len(d["text"] or "") < 4000]
    got = {str(tuple(r)) for r in periodic_runs.query(shipped, folder).collect()}
    assert len(got) == len(docs)
    assert {str(plain_row(*d)) for d in short} <= got
