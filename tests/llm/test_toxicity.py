"""Toxicity: gradients, windows, held-out accuracy and awkward rows."""

import random
import zlib

import numpy as np
import pytest

from duebook.llm import toxicity
from duebook.llm.shared import ship

FOLDER = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, lang string, score string, toxic string"


@pytest.fixture(scope="module")
def shipped(spark):
    ship(spark)
    return spark


def made_texts(n, seed):
    """Texts of invented words; every fourth holds one of a few stems with an arbitrary ending."""
    r = random.Random(seed)
    words = ["".join(r.choice("bdfglmnprst") + r.choice("aeiouéö") for _ in range(r.randint(1, 3))) for _ in range(300)]
    texts, labels = [], []
    for i in range(n):
        text = [r.choice(words) for _ in range(r.randint(5, 150))]
        if i % 4 == 0:
            for _ in range(r.randint(1, 3)):
                text[r.randrange(len(text))] = r.choice(["zwick", "Zwack", "quorx"]) + r.choice(["", "en", "ö", "ette", "s!"])
        texts.append(" ".join(text))
        labels.append(int(i % 4 == 0))
    return texts, labels


def test_gradients_equal_differences():
    r = np.random.default_rng(0)
    net = toxicity.Network(4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = r.standard_normal((5, 3, toxicity.INPUTS))
    mask = np.ones((5, 3))
    mask[4, 0] = mask[2:, 1] = 0
    y, weight = np.array([0, 1, 1.0]), np.array([0.3, 0.5, 1.0])
    _, gradients, dx = net.gradients(x, mask, y, weight)

    def loss():
        logit = net.logits(net.gates(x), mask)
        return float((weight * (np.logaddexp(0, logit) - y * logit)).sum())

    for array, gradient in [(net.p[k], gradients[k]) for k in gradients] + [(x, dx)]:
        for _ in range(4):
            at = tuple(r.integers(0, s) for s in array.shape)
            value = array[at]
            array[at] = value + 1e-3
            above = loss()
            array[at] = value - 1e-3
            below = loss()
            array[at] = value
            assert abs((above - below) / 2e-3 - gradient[at]) < 1e-4


def test_windows_cover_every_word_and_overlap():
    counts = np.array([0, 1, toxicity.WINDOW, toxicity.WINDOW + 1, 0, 200])
    text, first = toxicity.windows_of(counts)
    starts = np.cumsum(counts) - counts
    for k, n in enumerate(counts.tolist()):
        own = first[text == k] - starts[k]
        covered = {i for f in own.tolist() for i in range(f, min(f + toxicity.WINDOW, n))}
        assert covered == set(range(n)) and all(0 < b - a <= toxicity.STRIDE for a, b in zip(own, own[1:], strict=False))


def test_stems_are_learned_and_found_at_the_end_of_a_long_text():
    texts, labels = made_texts(700, 1)
    model = toxicity.train(texts[:560], labels[:560], [zlib.crc32(t.encode()) for t in texts[:560]])
    scores = model.scores(texts[560:])
    assert ((scores >= 0.5) == np.array(labels[560:], bool)).mean() > 0.93
    clean = " ".join(t for t, label in zip(texts, labels, strict=True) if not label)[:20_000]
    assert model.scores([clean + " zwacken quorxette"])[0] >= 0.5
    # a score depends on the text alone, whatever stands beside it
    assert model.scores([texts[600]])[0] == pytest.approx(scores[40], abs=2e-5)
    assert model.scores([None, "", " .,; "]).tolist() == [round(model.base, 5)] * 3


def test_held_out_accuracy_on_the_given_documents(shipped):
    labels = {r["doc_id"]: r["toxic"] for r in shipped.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = toxicity.query(shipped, FOLDER).collect()
    assert len(rows) == shipped.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    own = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    toxic = [p for p, y in own if y]
    clean = [p for p, y in own if not y]
    assert sum(toxic) / len(toxic) > 0.85 and sum(clean) / len(clean) < 0.02


def test_awkward_tables(shipped):
    texts, labels = made_texts(120, 2)
    rows = [(i, t, "en", "x", "y") for i, t in enumerate(texts)] + [(3, texts[3], "de", "", ""), (None, texts[0], None, None, None), (500, None, "en", "", ""), (501, "", "", "", "")]
    docs = shipped.createDataFrame(rows, SCHEMA)
    marked = shipped.createDataFrame([(i, None, y, "extra") for i, y in enumerate(labels)] + [(None, 1, 1, ""), (4, 1, None, ""), (4, 0, 1, "")], "doc_id long, quality int, toxic int, score string")
    model = toxicity.fit(docs, marked)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], set()).add((r["score"], r["predicted"]))
    assert len(by_id[3]) == 1 and by_id[500] == by_id[501] == {(round(model.base, 5), 0)}
    assert toxicity.score(docs.limit(0), model).collect() == []
    # without labels, or with one class only, nothing is marked
    for none in (marked.limit(0), marked.filter("toxic = 0")):
        assert {r["predicted"] for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0}
