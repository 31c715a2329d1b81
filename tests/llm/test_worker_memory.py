"""What Python workers hold: one worker a task, memory given back, words as numbers."""

import re
import tracemalloc

from pyspark.sql import functions as F

import corpus_pipeline
from duebook.llm import decontaminate, shared

LINE = "A shared line that is clearly longer than forty characters."


class _Pool:
    given_back = 0

    def release_unused(self):
        self.given_back += 1


def test_memory_goes_back_when_a_task_ends(monkeypatch):
    pool = _Pool()
    monkeypatch.setattr(shared.pa, "default_memory_pool", lambda: pool)
    task = shared.releasing(lambda rows: (2 * x for x in rows))(iter([1, 2]))
    assert [next(task), next(task), pool.given_back] == [2, 4, 0]
    assert list(task) == [] and pool.given_back == 1


def test_lines_are_edited_once(spark):
    """A filter on the edited text shares its one evaluation, so no task needs two Python workers."""
    shared.ship(spark)
    rows = [(i, f"{LINE}\nword {i}", "en", "host", 1) for i in range(6)] + [(6, LINE, "en", "host", 1), (7, LINE, "en", "host", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.lines(spark, docs, "")
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"ArrowEvalPython \[_kept_text", plan)) == 1
    assert sorted(r.doc_id for r in left.collect()) == [0, 1, 2, 3, 4, 5, 7]
    assert {r.text for r in left.filter(F.col("doc_id") < 6).collect()} == {f"word {i}" for i in range(6)}


def test_words_of_a_shard_are_numbers():
    test = decontaminate.TestWords([(1, " ".join(f"t{i}" for i in range(20)))], 10)
    texts = [[b"t%d" % i for i in range(4, 18)], *[[b"w%d" % (i % 977) for i in range(2_000)] for _ in range(200)]]
    ids = [test.ids_of(words) for words in texts]
    assert sum(a.nbytes for a in ids) == 4 * sum(map(len, texts))
    tracemalloc.start()
    found = decontaminate.search_ids(test, ids)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == decontaminate.search_shard(test, texts)
    assert found[0][:3] == (14, list(range(14)), {1}) and all(f[1:4] == ([], set(), 0) for f in found[1:])
    assert peak < 20 * sum(map(len, texts))
