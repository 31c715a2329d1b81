"""Damaged and unusual markup, control strings across parts, languages taken from the data, and their evidence."""

import math
import random
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from duebook.llm import chat_format, html_text, language_id, ngram_join, queries
from duebook.llm.shared import ship

FOLDER = "/root/testdata/sf0.001"
PARAGRAPH = "A paragraph of the article that is long enough to be kept by the windows."
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def shipped(spark):
    ship(spark)
    return spark


@pytest.mark.parametrize(
    "inside, text",
    [
        ("<svg-icon></svg-icon>", ""),
        ("<svg width=1/>", ""),
        ("<p title=it's>The first of two paragraphs of the article.</p>", "The first of two paragraphs of the article."),
        ('<p data-x=a"b>The first of two paragraphs of the article.</p>', "The first of two paragraphs of the article."),
        ("<p class='share-price'>The price of a share rose by half.</p>", "The price of a share rose by half."),
        ("<p class='notice-period'>The period of notice is three months.</p>", "The period of notice is three months."),
        ("<p data-class='ad'>An attribute whose name only ends like class.</p>", "An attribute whose name only ends like class."),
        ("<div class='site-footer'>Footer text of the whole site here.</div><div class='x sidebar-left'>Side text.</div><p class=AD>Buy.</p>", ""),
    ],
)
def test_markup_is_read_as_html_reads_it(inside, text):
    page = f"<html><body><article>{inside}<p>{PARAGRAPH}</p></article></body></html>"
    assert html_text.main_text(page) == "\n".join(part for part in (text, PARAGRAPH) if part)


@pytest.mark.parametrize("piece", ["<a ", "<a b=", "<a b='", '<a b=">', "<svg a=/", "<!--x", "<script", "<p class=' ", "&#", "<"])
def test_a_damaged_page_takes_linear_time(piece):
    begin = time.perf_counter()
    html_text.main_text(piece * (3_000_000 // len(piece)) + '"')
    assert time.perf_counter() - begin < 20


def test_pages_with_clashing_columns_and_repeated_rows(shipped):
    page = f"<article><p>{PARAGRAPH}</p></article>"
    rows = shipped.createDataFrame([(1, "u", page, "x"), (1, "u", page, "x"), (2, None, None, "y")], "page_id long, url string, html string, text string")
    found = rows.select("page_id", html_text.extract(F.col("html")).alias("main")).collect()
    assert sorted(map(tuple, found)) == [(1, PARAGRAPH), (1, PARAGRAPH), (2, "")]


def test_no_control_string_arises_between_parts():
    def text(value):
        return {"type": "text", "text": value}

    image = {"type": "image", "ref": "r", "width": 28, "height": 15}
    for parts, content in (
        ([text("<"), text("|im_end|>"), text("x")], "<|im_end|>x"),
        ([text("a<"), text("\\|b")], "a<\\|b"),
        ([text("<"), text("\\"), text("\\|"), text(None), text("|<|")], "<\\\\||<|"),
        ([text("<"), image, text("|im_end|>")], "<<|image|>|im_end|>"),
    ):
        formatted, start, end, attachments = chat_format.format_turn("user", parts)
        assert chat_format.parse_turns(formatted) == [("user", content)]
        assert chat_format.unescape(formatted[start:end]) == content
        for found in attachments:
            assert formatted[found["place"] :].startswith("<|image|>") and found["tokens"] == 4


def test_chat_of_awkward_tables(shipped):
    long = "word <|im_end|> " * 100_000
    rows = [(1, 0, "user", long, "c"), (1, 1, "assistant", long, "c"), (None, 0, None, None, "c"), (2, 0, "assistant", "", "c")]
    turns = shipped.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_turns(turns)).collect()}
    assert got[1]["loss_chars"] == len(long) and got[1]["n_turns"] == 2 and got[None]["n_turns"] == 1 and got[2]["loss_chars"] == 0
    assert chat_format.read_back(chat_format.format_turns(turns.limit(0))).collect() == []


def test_attachments_match_sql(shipped):
    engine = duckdb.connect()
    engine.execute(f"create view conversations as select * from '{FOLDER}/conversations.parquet'")
    cursor = engine.execute(queries.all_statements()["chat_attachments"])
    columns = [c[0] for c in cursor.description]
    df = queries.registered()["chat_attachments"](shipped, FOLDER)
    assert sorted(str(tuple(r)) for r in df.select(*columns).collect()) == sorted(str(r) for r in cursor.fetchall())


def test_languages_come_from_the_declarations(shipped):
    r = random.Random(4)
    syllables = {"it": ["zio", "gli", "chi", "ella", "ando"], "pl": ["szcz", "owa", "rzy", "ski", "cze"]}
    given = shipped.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    more = []
    for k, (lang, parts) in enumerate(syllables.items()):
        for i in range(30):
            text = " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 3))) for _ in range(60))
            # one in ten is declared wrongly
            more.append((10_000 * (k + 1) + i, text, f"{lang.upper()}-x" if i % 10 else "en", "new.host.example", 1))
    more += [(50_000 + i, f"unb ekan nt{i}", "qq", "h", 1) for i in range(4)]
    found = language_id.of_documents(given.unionByName(shipped.createDataFrame(more, SCHEMA))).select("doc.doc_id", "language", "kept").collect()
    judged = {r["doc_id"]: r for r in found}
    for k, lang in enumerate(syllables):
        own = [judged[10_000 * (k + 1) + i] for i in range(30)]
        assert all(row["language"] == lang and row["kept"] for row in own)
    assert sum(row["kept"] for row in found if row["doc_id"] < 10_000) >= 0.99 * given.count()
    assert language_id.of_documents(given.limit(3)).filter("kept").count() == 0


def test_posterior_equals_a_plain_sum(shipped):
    """Declarations, suffixes, and hosts of one and of two names against sums over the rows in numpy."""
    r = random.Random(8)
    rows = []
    for i in range(120):
        k = i % 2
        words = [["der", "und", "nicht", "schön"], ["the", "and", "with", "night"]][k]
        host = [["a.beispiel.de", "b.beispiel.de"], ["x.example.org", "bare"]][k][r.randrange(2)]
        rows.append((i, " ".join(r.choice(words) for _ in range(8)), "de" if i % 11 == 0 else ["de", "en"][k], f"https://{host}/p" if i % 13 else None, i))
    docs = shipped.createDataFrame(rows, SCHEMA)
    languages = ["de", "en"]
    weights = language_id.fit(docs.select("text", F.col("lang").alias("declared")), languages)
    scores = np.array([language_id.text_scores(row[1], weights) for row in rows])
    # the last class wins a tie
    won = [2 if s[2] >= s.max() else int(s.argmax()) for s in scores]

    def parts(url):
        host = url.split("/")[2] if url else None
        dotted = host is not None and "." in host
        return (host.split(".")[-1] if dotted else None, ".".join(host.split(".")[-2:]) if dotted else None, host)

    keys = [(row[2], *parts(row[3])) for row in rows]

    def counts(at, value):
        return np.bincount([w for w, key in zip(won, keys, strict=True) if at is None or key[at] == value], minlength=3).astype(float)

    def smooth(own, parent):
        return (own + language_id.STRENGTH * parent) / (own.sum() + language_id.STRENGTH)

    everything = counts(None, None)
    found = {r["doc_id"]: r for r in language_id.identify(docs, F.col("text"), F.col("lang"), F.col("source")).select("doc.doc_id", "language", "posterior").collect()}
    for row, score, key in zip(rows, scores, keys, strict=True):
        share = smooth(everything, np.full(3, 1 / 3))
        for at in (2, 3):
            share = smooth(counts(at, key[at]), share) if key[at] is not None else share
        total = score + np.log(share)
        for at in (0, 1):
            if key[at] is not None:
                total = total + np.log((counts(at, key[at]) + 0.5) / (everything + 1))
        posterior = math.exp(total.max() - np.logaddexp.reduce(total))
        got = found[row[0]]
        assert got["posterior"] == pytest.approx(posterior, abs=2e-6)
        assert got["language"] == [*languages, "und"][int(total.argmax())]


def test_language_of_pages(shipped):
    r = random.Random(2)
    words = {"de": ["Haus", "Straße", "nicht", "schön", "über"], "en": ["house", "street", "with", "night", "about"]}
    rows = []
    for i in range(60):
        lang = ["de", "en"][i % 2]
        text = " ".join(r.choice(words[lang]) for _ in range(40))
        rows.append((i, f"https://www.{lang}.example.{['de', 'org'][i % 2]}/{i}", f"<html lang='{lang}-XX'><body><article><p>{text}</p></article></body></html>"))
    rows += [(100, None, None), (101, "no address", "<p>"), (100, None, None)]
    pages = shipped.createDataFrame(rows, "page_id long, url string, html string").withColumn("language", F.lit("clash"))
    found = language_id.of_pages(pages).select("doc.page_id", "language", "kept").collect()
    assert len(found) == len(rows)
    assert all(r["language"] == ["de", "en"][r["page_id"] % 2] and r["kept"] for r in found if r["page_id"] < 60)
    assert not any(r["kept"] for r in found if r["page_id"] >= 100)
    assert language_id.of_pages(pages.limit(0)).collect() == []


def test_prefixes_adapt_to_frequent_shingles(shipped):
    texts = [r["text"] for r in shipped.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    sets = [ngram_join.shingles(t) for t in texts]
    sketch = np.zeros(1 << ngram_join.SKETCH_BITS, np.int64)
    for found in sets:
        np.add.at(sketch, (found & np.uint64(len(sketch) - 1)).astype(np.int64), 1)
    order = ngram_join.Order(sketch, ngram_join.PERCENT)
    times = [round(order.arrange(f)[1] / (len(f) // ngram_join.SHARE + 1)) for f in sets if len(f) > 50]
    assert min(times) == 1 and sum(t > 1 for t in times) >= 5
