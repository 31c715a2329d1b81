"""The training data operators against plain versions, on small fixtures with awkward rows."""

import hashlib
import itertools
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from duebook.llm import chat_format, decontaminate, html_text, language_id, license_scan, line_dedup, ngram_join, packing, quality_rules, queries, token_codes
from duebook.llm.shared import CachedEncoder, ship

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "A shared line that is clearly longer than forty characters."


@pytest.fixture(scope="module")
def shipped(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="module")
def docs(shipped):
    """Nulls, empty and long texts, ties, repeated rows, copies and clashing column names."""
    words = [f"w{i}" for i in range(300)]
    r = random.Random(5)
    base = " ".join(r.choice(words) for _ in range(120))
    near = base.replace(base.split()[60], "changed", 1)
    rows = [(i, f"{LONG}\n{base}\n", "en", "host", 1) for i in range(1, 8)]
    rows += [(20, near, "en", "host", 1), (21, base, None, None, None), (22, "", "en", "", 0), (23, None, "en", "host", 0), (23, None, "en", "host", 0)]
    rows += [(30, "the MIT License and the mit license", "en", "h.de", 5), (30, "the MIT License and the mit license", "en", "h.de", 5)]
    rows += [(None, "a null id", "fr", "x", 9), (40, " ".join(r.choice(words) for _ in range(30_000)), "en", "host", 1)]
    rows += [(41, "one two one two one two one two one two one two", "en", "host", 1), (42, "\n\n \t\n", "de", "host", 1)]
    extra = shipped.createDataFrame(rows, SCHEMA)
    return extra.withColumn("n_words", F.lit("clash")).withColumn("part", F.lit(1)).withColumn("class", F.lit("x"))


@pytest.fixture(scope="module")
def empty(shipped):
    return shipped.createDataFrame([], SCHEMA)


def collect(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("name", [n for n in queries.MODULES if queries.MODULES[n].SQL])
def test_queries_match_sql(shipped, name):
    engine = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "conversations"):
        engine.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    df = queries.registered()[name](shipped, FOLDER)
    cursor = engine.execute(queries.all_statements()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    got = df.select(*columns).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(str(r) for r in cursor.fetchall())


def test_empty_tables(shipped, empty):
    bench = shipped.createDataFrame([], "item_id long, text string")
    assert collect(line_dedup.keep_bitmaps(empty)) == []
    assert collect(decontaminate.decontaminate(empty, bench)) == []
    assert collect(packing.packed(empty)) == []
    assert collect(quality_rules.apply_rules(empty)) == []
    assert collect(license_scan.scan(empty)) == []
    assert collect(ngram_join.link(empty)) == []
    assert collect(language_id.of_documents(empty)) == []
    assert collect(html_text.query.__globals__["extract"] and empty.select(html_text.extract(F.col("text")))) == []
    import public_tokenizers

    assert collect(token_codes.read_documents(token_codes.write_codes(empty, public_tokenizers.path("byte_bpe_50k.json")))) == []


def test_line_dedup_awkward_rows(docs):
    found = line_dedup.keep_bitmaps(docs, min_documents=5).collect()
    by_id = {r.doc_id: r for r in found}
    assert [by_id[i].n_dropped for i in range(1, 8)] == [2] * 6 + [1]  # document 21 holds the second line too
    assert line_dedup.read_bitmap(by_id[1].bitmap, 3).tolist() == [False, False, True]
    assert by_id[22].n_lines == by_id[23].n_lines == 1 and by_id[line_dedup.NO_DOCUMENT].n_dropped == 0
    applied = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs)).collect()
    assert len(applied) == docs.count()
    assert {r.kept_text for r in applied if r.doc.doc_id == 1} == {""}


def test_line_dedup_hot_line_over_many_partitions(shipped):
    shipped.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        rows = shipped.range(3000).select(F.col("id").alias("doc_id"), F.lit(f" {LONG.upper()}\nown").alias("text"))
        found = line_dedup.keep_bitmaps(rows).groupBy("n_dropped").count().collect()
        assert {r.n_dropped: r["count"] for r in found} == {1: 2999, 0: 1}
    finally:
        shipped.conf.set("spark.sql.shuffle.partitions", "4")


def test_decontamination_by_brute_force(shipped, docs):
    r = random.Random(2)
    pool = list("abcdef")
    items = [(i, " ".join(r.choice(pool) for _ in range(r.choice([0, 3, 12, 25])))) for i in range(12)] + [(99, None), (7, "A b!")]
    texts = [(i, " ".join(r.choice(pool) for _ in range(r.randrange(0, 400)))) for i in range(30)]
    both = shipped.createDataFrame(texts, "doc_id long, text string")
    found = decontaminate.decontaminate(both, shipped.createDataFrame(items, "item_id long, text string"), block_chars=60).collect()
    windows = defaultdict(set)
    for item_id, text in items:
        w = re.findall("[0-9a-z]+", (text or "").lower())
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add(item_id)
    for row in found:
        w, hit, ids = row.doc.text.split(), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    ids |= windows[tuple(w[i : i + n])]
        assert (row.n_words, row.n_hit, set(row["items"])) == (len(w), len(hit), ids)
    assert decontaminate.decontaminate(docs, shipped.createDataFrame(items, "item_id long, text string")).count() == docs.count()


def test_longest_matches_by_brute_force(shipped):
    """Copies of a passage, and shorter matches beside longer ones, in one shard."""
    r = random.Random(6)
    pool = list("abcde")
    items = [(i, " ".join(r.choice(pool) for _ in range(n))) for i, n in enumerate([25, 25, 14, 8, 40])] + [(7, None), (None, "z y x w v u t s r q p")]
    items += [(9, items[0][1])]
    passage = items[4][1].split()
    texts = [" ".join(["other", *passage[:20], "words"]) for _ in range(30)]
    texts += [" ".join(["x"] * k + passage[:12] + ["y"]) for k in range(5)]
    texts += [" ".join(r.choice(pool) for _ in range(r.randrange(0, 200))) for _ in range(20)]
    texts += ["", None, "z y x w v u t s r q p", " ".join(passage * 2)]
    words = [(i, (text or "").split()) for i, text in items]
    q = 8

    def longest(text):
        w, best = (text or "").split(), (0, None, None)
        for k in range(len(w)):
            for item_id, a in words:
                for j in range(len(a)):
                    n = 0
                    while k + n < len(w) and j + n < len(a) and w[k + n] == a[j + n]:
                        n += 1
                    better = n > best[0] or n == best[0] and k == best[1] and item_id is not None and (best[2] is None or item_id < best[2])
                    if n >= q and better:
                        best = (n, k, item_id)
        return best

    rows = shipped.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    bench = shipped.createDataFrame(items, "item_id long, text string")
    for block in (decontaminate.BLOCK_CHARS, 60):
        for row in decontaminate.decontaminate(rows, bench, block_chars=block).collect():
            assert tuple(row.longest) == longest(row.doc.text)


def test_encoder_equals_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    r = random.Random(3)
    letters = list("abZ éÉßñ’'.,-19 \n#<|>İςж́²½\t don'tI've")
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(1, 60))) for _ in range(3000)]
    texts += ["don't stop", "\x01 x", "a  b", " a", "á.b", "<|endoftext|> hi", "Ünï-cödé d'été\nx"]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        plain, cached = Tokenizer.from_file(public_tokenizers.path(name)), CachedEncoder(public_tokenizers.path(name), limit=50)
        expected = [plain.encode(text, add_special_tokens=False).ids for text in texts]
        for text, ids in zip(texts[:300], expected, strict=False):
            assert cached(text) == np.asarray(ids, "<u4").tobytes()
        for i in range(0, len(texts), 97):
            assert [ids.tolist() for ids in cached.encode_all([*texts[i : i + 97], None, ""])] == [*expected[i : i + 97], [], []]


def test_token_codes(shipped, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    r = np.random.default_rng(1)
    for n in (0, 1, 511, 512, 513, 4000):
        ids = r.integers(0, 70_000, n).astype(np.uint32)
        codes = token_codes.Codes(token_codes.Codes.encode(ids))
        assert (codes.decode() == ids).all() and all(codes[i] == ids[i] for i in range(n))
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, start, expected = Tokenizer.from_file(path), 0, []
    rows = sorted(((x.doc_id, x.text) for x in docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0))
    for doc_id, text in rows:
        ids = np.asarray([*plain.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(collect(token_codes.read_documents(token_codes.write_codes(docs, path))), key=str) == sorted(expected, key=str)


def test_packing(docs):
    rows = packing.packed(docs).collect()
    assert len({(r.doc_id, r.piece) for r in rows}) == len(rows) - 2  # two repeated rows
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_packed_pieces_equal_plain_ids(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain, expected = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), []
    for row in docs.collect():
        ids = np.asarray([*plain.encode(row.text or "", add_special_tokens=False).ids, packing.END], "<u4")
        for piece, at in enumerate(range(0, len(ids), packing.CAPACITY)):
            own = ids[at : at + packing.CAPACITY]
            expected.append((row.doc_id, piece, at, len(own), zlib.crc32(own.tobytes())))
    found = packing.packed(docs).select("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(collect(found), key=str) == sorted(expected, key=str)
    assert max(piece for _, piece, *_ in expected) > 1


def test_plan_is_optimal_on_small_instances():
    def best(sizes):
        bins = len(sizes)

        def place(i, rooms):
            nonlocal bins
            if len(rooms) >= bins:
                return
            if i == len(sizes):
                bins = len(rooms)
                return
            for k in {room: k for k, room in enumerate(rooms) if room >= sizes[i]}.values():
                place(i + 1, [*rooms[:k], rooms[k] - sizes[i], *rooms[k + 1 :]])
            place(i + 1, [*rooms, 20 - sizes[i]])

        place(0, [])
        return bins

    r, extra = random.Random(4), 0
    for _ in range(60):
        sizes = sorted((r.randint(1, 20) for _ in range(10)), reverse=True)
        plan = packing.Plan(Counter(sizes), 20)
        assert Counter(itertools.chain.from_iterable(p * n for p, n in plan.patterns)) == Counter(sizes)
        assert all(sum(p) <= 20 for p, _ in plan.patterns)
        extra += sum(n for _, n in plan.patterns) - best(sizes)
    assert extra <= 1


def test_chat_parts_and_escaping(shipped):
    parts = [{"type": "text", "text": "see <|im_end|>"}, {"type": "image", "ref": "i", "width": 28, "height": 15}, {"type": "audio", "ref": "a", "seconds": 2.0}]
    text, start, end, attached = chat_format.format_turn("user", [*parts, {"type": "document", "ref": "d", "pages": 3}])
    assert [(a["type"], a["ref"], a["tokens"]) for a in attached] == [("image", "i", 4), ("audio", "a", 50), ("document", "d", 768)]
    assert all(text[a["place"] :].startswith(chat_format.PLACEHOLDER[a["type"]]) for a in attached)
    assert chat_format.unescape(text[start:end]).startswith("see <|im_end|>")
    for raw in ("<|", "<\\|", "<\\\\||", "<<|x|>", "\\<|", "<"):
        assert chat_format.unescape(chat_format.escape(raw)) == raw and "<|" not in chat_format.escape(raw)
    with pytest.raises(ValueError):
        chat_format.format_turn("user", [{"type": "video"}])
    rows = [(1, 0, "user", None), (1, 1, "assistant", "x"), (1, 1, "assistant", "x"), (None, 0, None, "")]
    turns = shipped.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat_format.read_back(chat_format.format_turns(turns)).collect()}
    assert (found[1].n_turns, found[1].loss_chars, found[None].n_turns) == (3, 2, 1)
    assert found[1].loss_sha256 == hashlib.sha256(b"xx").hexdigest()


def test_html_without_marked_article():
    page = """<html><head><title>t</title><script>var t="<p>no</p>";</script></head><body><div id="top-menu"><a href=x>a</a></div>
    <div><p>One   paragraph of the article, long enough to be a surge of text &amp; more.</p><p>Short.</p><p>Another <b>bold</b>ly long paragraph
    that goes on for a while, so that the window stays high.</p></div><div class="comments"><p>A reader comment that is long enough to look like text
    of an article but is not.</p></div><footer>foot</footer>"""
    assert html_text.main_text(page) == (
        "One paragraph of the article, long enough to be a surge of text & more.\nShort.\n"
        "Another boldly long paragraph that goes on for a while, so that the window stays high."
    )
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p") == ""


def test_html_article_marks():
    long = [f"Paragraph {i} of the page's own text, which is long enough to be a surge by itself, as most are." for i in range(4)]
    body = "<div>" + "".join(f"<p>{line}</p>" for line in long) + "</div>"
    # teasers and comments are no article of the page
    teasers = "".join(f"<article><h3>Teaser {i}</h3></article>" for i in range(3))
    comments = '<article class="comment"><p>A reader says what readers say, at a length that would be a surge of text.</p></article>' * 3
    assert html_text.main_text(f"<body>{body}{comments}</body>") == "\n".join(long)
    assert html_text.main_text(f"<body>{teasers}{body}</body>").split("\n")[-4:] == long
    # the article bounds the windows, its short lines stay and a list of links in it dives
    menu = "".join(f"<li><a href=x>Link number {i}</a>" for i in range(5))
    other = "<p>An imprint without a mark, which is long enough to be a surge of text in any window of lines.</p>"
    page = f"<body>{other}<main><h1>Title</h1>{body}<p>Short.</p><ul>{menu}</ul><div class=ad>x</div><p>End.</p></main>{other}</body>"
    assert html_text.main_text(page) == "\n".join(["Title", *long, "Short.", "End."])


def test_html_dropped_elements_without_end_tag():
    text = html_text.main_text
    assert text('<article><p>Begin</p><ul><li class="share">x<li>y</ul><p>rest</p></article>') == "Begin\ny\nrest"
    assert text('<main><article><p>Begin</p><div class="ad">x<p>y</article><p>rest</p></main>') == "Begin\nrest"
    assert text('<article><div><div class="ad">x<div>y</div></div>z</div><p>rest</article>') == "z\nrest"
    assert text('<article><section><div class="ad">x</section><p>rest</p></article>') == "rest"
    assert text('<article><table><tr><td class="ad">x<td>y<tr class="ad"><td>z<tr><td>v</table><dl><dt class="ad">x<dd>w</dl></article>') == "y\nv\nw"
    assert text('<article><ul><li class="share"><ul><li>x<li>y</ul></li><li>z</ul></article>') == "z"
    assert text('<article><p><span class="ad">x</p><p>rest</p></article>') == "rest"
    assert text('<article><p class="notice">a<br>b</p><p>rest</p></article>') == "rest"
    reply = '<article class="comment">x<article class="comment">y</article>z</article>'
    assert text(f"<article><p>Begin</p>{reply}<p>rest</p></article>") == "Begin\nrest"


def test_quality_and_licences_awkward_rows(docs):
    rows = {r.doc_id: r for r in quality_rules.apply_rules(docs).collect()}
    assert rows[41].n_repeat_words == 12 and rows[41].base_failed and not rows[23].kept and rows[40].n_words == 30_000
    assert quality_rules.apply_rules(docs).count() == docs.count()
    found = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    assert (found[30].n_base, found[30].first_word, found[30].last_word, found[30].base_labels) == (2, 1, 5, "mit")
    assert (found[23].labels, found[23].score, found[23].first_word) == ("", 0.0, None)


def test_wrapped_licence_notices(shipped):
    import textwrap

    texts = [("mit", license_scan.TEMPLATES[6][1]), ("bsd", license_scan.TEMPLATES[1][1]), ("mpl-2.0", license_scan.TEMPLATES[7][1])]
    rows = []
    for width, mark in ((72, ""), (30, " * "), (16, "# ")):
        rows += [(label, "intro words\n" + "\n".join(mark + line for line in textwrap.wrap(text, width)) + "\nother words") for label, text in texts]
    # the words of a notice far apart are no notice, and a line may be longer than its template
    rows += [("", "\n".join(f"{w} and some other words between them" for w in texts[0][1].split()))]
    rows += [("mit", texts[0][1].replace(" ", " or so "))]
    given = shipped.createDataFrame([(i, text) for i, (_, text) in enumerate(rows)], "doc_id long, text string")
    found = {x.doc_id: (x.labels, x.score) for x in license_scan.scan(given).collect()}
    assert found == {i: (label, 1.0 if label else 0.0) for i, (label, _) in enumerate(rows)}


def test_depleted_documents_go(shipped):
    shared = "\n".join(f"line number {i} of the text that all the documents of this host share" for i in range(4))
    texts = [(i, f"{shared}\nown {i}", "en", "h", 1) for i in range(30)]
    texts += [(100 + i, " ".join(f"u{i}x{j}" for j in range(40)), "en", "h", 1) for i in range(30)]
    kept = {r.doc_id: r.kept for r in quality_rules.apply_rules(shipped.createDataFrame(texts, SCHEMA)).collect()}
    assert not any(kept[i] for i in range(30)) and all(kept[100 + i] for i in range(30))


def test_lines_above_the_fixed_count_go(shipped):
    # 30 of 1200 documents are under the share of their host, but above a fixed count of 25
    texts = [(i, f"own {i}\n\n  A Banner \nlast {i}", "en", "h", 1) for i in range(30)]
    texts += [(100 + i, f"rare line\nown {100 + i}", "en", "h", 1) for i in range(22)]
    texts += [(1000 + i, f"own {1000 + i}", "en", "h", 1) for i in range(1148)]
    given = shipped.createDataFrame(texts, SCHEMA)
    found = {r.doc_id: r for r in quality_rules.apply_rules(given, max_documents=25).collect()}
    assert len(found) == 1200
    assert all(found[i].removed_chars == len("  A Banner ") and found[i].clean_text == f"own {i}\n\nlast {i}" for i in range(30))
    assert all(found[i].clean_text == text and not found[i].removed_chars for i, text, *_ in texts[30:])
    # the share of the host holds below the fixed count
    assert {r.removed_chars for r in quality_rules.apply_rules(given).collect()} == {0}
    assert quality_rules.MIN_DOCUMENTS < quality_rules.MAX_DOCUMENTS


def _groups(texts):
    low = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    sets = []
    for text in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(low))
        sets.append({tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set())
    root = list(range(len(sets)))
    links = [0] * len(sets)
    for i, j in itertools.combinations(range(len(sets)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 85 * len(sets[i] | sets[j]):
            links[i] += 1
            links[j] += 1
            a, b = root[i], root[j]
            root = [min(a, b) if x in (a, b) else x for x in root]
    return sets, root, links


def test_ngram_join_by_brute_force(shipped, docs, monkeypatch):
    r = random.Random(8)
    texts = []
    for _ in range(8):
        base = [f"t{r.randrange(500)}" for _ in range(r.choice([3, 30, 90]))]
        for _ in range(12):
            own = list(base)
            for _ in range(r.choice([0, 1, 2, 4])):
                own[r.randrange(len(own))] = f"e{r.randrange(10**6)}"
            texts.append(" ".join(own))
    rows = shipped.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets, root, links = _groups(texts)
    expected = [(i, len(sets[i]), root[i], links[i]) for i in range(len(texts))]
    for block in (ngram_join.BLOCK_SHINGLES, 200):
        monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", block)
        found = ngram_join.link(rows).select("doc_id", "n_shingles", "component_id", "n_links")
        assert sorted(collect(found)) == expected
    assert ngram_join.link(docs).count() == docs.count()
    left = ngram_join.one_of_each_group(docs)
    assert left.columns == docs.columns and left.filter("doc_id in (1, 2, 3, 4, 5, 6, 7)").count() == 1


def test_language_evidence(shipped, docs):
    rows = language_id.of_documents(docs).collect()
    assert len(rows) == docs.count()
    assert not any(r.kept for r in rows if not (r.doc.text or "").strip())
    given = shipped.read.parquet(f"{FOLDER}/documents.parquet")
    found = language_id.of_documents(given)
    # held-out accuracy: labels hidden from every other document's evidence
    hidden = language_id.of_documents(given.withColumn("lang", F.when(F.pmod("doc_id", F.lit(2)) == 0, F.col("lang"))))
    truth = {r.doc_id: r.lang for r in given.collect()}
    held_out = [(r.doc.doc_id, r.language) for r in hidden.collect() if r.doc.doc_id % 2]
    assert sum(truth[i] == x for i, x in held_out) >= 0.98 * len(held_out)
    assert found.filter("kept").count() >= 0.99 * given.count()
    noise = [(i, "".join(random.Random(i).choice("qxzjkvwyg ") for _ in range(400)), "en", "n", 1) for i in range(5)]
    judged = language_id.of_documents(given.unionByName(shipped.createDataFrame(noise, SCHEMA).withColumn("doc_id", F.col("doc_id") + 10**6)))
    assert judged.filter("doc.doc_id >= 1000000 and kept").count() == 0
    # random letters under a label, each text twice
    r = random.Random(3)
    noise = [(i, "".join(r.choice("qxzjkvwyg ") for _ in range(r.randrange(80, 900))), "en", "n", 1) for i in range(8)] * 2
    judged = language_id.of_documents(given.unionByName(shipped.createDataFrame(noise, SCHEMA).withColumn("doc_id", F.col("doc_id") + 10**6)))
    assert judged.filter("doc.doc_id >= 1000000 and kept").count() == 0
    assert judged.filter("doc.doc_id < 1000000 and kept").count() >= 0.99 * given.count()


def test_pipeline_stages(shipped, docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_join", "decontamination", "packing"]
    given, stages = shipped.read.parquet(f"{FOLDER}/documents.parquet"), dict(corpus_pipeline.STAGES)
    kept = stages["language_id"](shipped, given, FOLDER)
    lines = stages["line_dedup"](shipped, kept, FOLDER)
    assert kept.columns == lines.columns == given.columns
    texts = {r.doc_id: r.text for r in lines.collect()}
    ids = sorted(texts)
    _, root, _ = _groups([texts[i] for i in ids])
    near = stages["ngram_join"](shipped, lines, FOLDER)
    assert {r.doc_id for r in near.collect()} == {ids[x] for x in root}
    clean = stages["decontamination"](shipped, near, FOLDER)
    assert clean.columns == given.columns
    packed = {r.doc_id for r in corpus_pipeline.run(shipped, FOLDER).collect()}
    assert packed == {r.doc_id for r in clean.collect()} and os.path.isdir(FOLDER)
