import random
import re

import pytest
from pyspark.sql import functions as F

from duebook.operators import joins, latest, numbering, patterns, shape, updates
from duebook.operators.propagate import propagate


def test_latest_counts_null_as_newest(spark, rows):
    df = spark.createDataFrame([(1, "2024-01-01"), (1, None), (2, "a"), (2, "b")], "k int, v string")
    assert rows(latest.latest_per_key(df, ["k"], [latest.newest("v")])) == [("1", None), ("2", "b")]


def test_latest_limits_groups_before_the_shuffle(spark, capsys):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    latest.latest_per_key(df, ["k"], [latest.newest("id")]).explain()
    plan = capsys.readouterr().out
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_pattern_join(spark, rows):
    df = spark.createDataFrame([("ELEC_MANUAL_BILL", None), ("_BILL", "x"), ("Z", "x")], "g string, a string")
    columns = [F.col("g"), F.coalesce("a", F.lit(""))]
    found = patterns.pattern_join(df, columns, [("%_BILL", "%"), ("%_MANUAL_BILL", "%"), ("Z", "y%")], "p")
    # '_' is one character, so '_BILL' has none left before 'BILL' but its own underscore
    assert rows(found, "g", "p") == [
        ("ELEC_MANUAL_BILL", "%_BILL"),
        ("ELEC_MANUAL_BILL", "%_MANUAL_BILL"),
        ("_BILL", "%_BILL"),
    ]
    once = patterns.pattern_join(df, columns, [("%_BILL", "%"), ("%_MANUAL_BILL", "%")], "p", match_once=True)
    assert rows(once, "g", "p") == [("ELEC_MANUAL_BILL", "%_BILL"), ("_BILL", "%_BILL")]
    assert df.filter(patterns.matches_any(columns, [])).isEmpty()


def test_updates(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (None, "n")], "k int, v string")
    source = spark.createDataFrame([(1, None), (2, "z"), (2, "y"), (3, "w"), (None, "q")], "s int, w string")
    keys, values = {"k": "s"}, {"v": "w"}
    assert rows(updates.update_from(target, source, keys, values)) == [
        ("1", None), ("2", "y"), ("3", "w"), (None, "n"),
    ]
    assert rows(updates.fill_from(target, source, keys, values)) == [("1", "a"), ("2", "b"), ("3", "w"), (None, "n")]
    assert rows(updates.set_where(target, F.col("v") == "a", {"v": F.lit("x")})) == [
        ("1", "x"), ("2", "b"), ("3", None), (None, "n"),
    ]
    assert rows(updates.delete_where(target, F.col("v") != "a")) == [("1", "a"), ("3", None)]
    assert rows(updates.delete_using(target, source.filter("s < 3"), keys)) == [("3", None), (None, "n")]
    assert rows(updates.keep_using(target, source.filter("s < 3"), keys)) == [("1", "a"), ("2", "b")]
    fresh = spark.createDataFrame([(2, "new")], "k int, v string")
    assert rows(updates.replace_by_key(target, source.filter("s = 2"), fresh, keys)) == [
        ("1", "a"), ("2", "new"), ("3", None), (None, "n"),
    ]


def test_lookup_keeps_null_keys(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, k string")
    right = spark.createDataFrame([("a", 10), (None, 11), ("a", 12)], "r string, v int")
    assert rows(joins.lookup(left, right, {"k": "r"}, "id"), "id", "v") == [
        ("1", "10"), ("1", "12"), ("2", None), ("3", None),
    ]


def test_lookup_spreads_null_keys(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(4000).withColumn("k", F.lit(None).cast("bigint"))
        right = spark.range(5).select(F.col("id").alias("r"))
        joined = joins.lookup(left, right, {"k": "r"}, "id")
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 2000


def test_full_merge_member_and_conditional_join(spark, rows):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int")
    right = spark.createDataFrame([("b", 3), ("c", 4)], "k string, y int")
    assert rows(joins.full_merge(left, right, "k")) == [("a", "1", None), ("b", "2", "3"), ("c", None, "4")]
    lists = spark.createDataFrame([(1, "d", ["a1", "a2", "a1"]), (2, "d", [])], "id int, doc string, ids array<string>")
    raw = spark.createDataFrame([("d", "a1"), ("d", "a3"), ("e", "a2")], "rdoc string, agg string")
    assert rows(joins.member_join(lists, raw, ["id"], {"doc": "rdoc"}, "ids", "agg")) == [("1", "a1")]
    a = spark.createDataFrame([(1, 7), (1, None)], "k int, t int")
    b = spark.createDataFrame([(1, 8, True), (1, 7, True), (1, 9, False)], "j int, u int, strict boolean")
    applies = F.col("strict") & F.col("t").isNotNull()
    got = joins.conditional_join(a, b, {"k": "j"}, applies, F.col("t") == F.col("u"))
    assert rows(got, "t", "u") == [("7", "7"), ("7", "9"), (None, "7"), (None, "8"), (None, "9")]


@pytest.mark.parametrize("seed", [1, 2])
def test_numbering_of_hot_keys_equals_the_plain_window(spark, rows, seed):
    rng = random.Random(seed)
    data = []
    for i in range(600):
        key = rng.choice(["hot"] * 6 + [None] * 3 + ["a", "b", "c"])
        data.append((i, key, rng.choice([None, *"pqrstuvw"]), rng.randrange(5)))
    df = spark.createDataFrame(data, "id int, k string, o string, v int")
    for limit in (20, 90):
        split = numbering.occurrence_number(df, ["k"], ["o"], "n", hot_rows=limit)
        assert rows(split) == rows(numbering.occurrence_number(df, ["k"], ["o"], "n", hot_rows=None))
        split = numbering.row_numbers(df, ["k"], ["o", "id"], "n", hot_rows=limit)
        assert rows(split) == rows(numbering.row_numbers(df, ["k"], ["o", "id"], "n", hot_rows=None))
        split = numbering.total_before(df, ["k"], ["o", "id"], "v", "n", hot_rows=limit)
        assert rows(split) == rows(numbering.total_before(df, ["k"], ["o", "id"], "v", "n", hot_rows=None))


def test_hot_keys_are_really_cut(spark):
    df = spark.range(10_000).select("id", F.lit("hot").alias("k"), F.col("id").alias("__tie"))
    cuts = numbering.cut_points(df, ["k"], ["id"], 1000).first()["__cuts"]
    assert len(cuts) == 10
    bounds = [0, *[c["value"]["v_id"] for c in cuts], 10_000]
    assert max(b - a for a, b in zip(bounds, bounds[1:], strict=False)) < 3000


def test_keys_are_cut_whatever_their_order_values(spark, rows):
    """As registered for the running occurrences: few order values, and one value for a whole key."""
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    df = lines.select("l_linenumber", F.col("l_quantity").cast("int").alias("quantity"), F.monotonically_increasing_id().alias("__tie"))
    df = df.unionByName(spark.range(9000).select(F.lit(99).alias("l_linenumber"), F.lit(7).alias("quantity"), (-1 - F.col("id")).alias("__tie")))
    hot = {r["l_linenumber"]: r["count"] for r in df.groupBy("l_linenumber").count().collect() if r["count"] > 2000}
    cuts = {r["__h_l_linenumber"]: r["__cuts"] for r in numbering.cut_points(df, ["l_linenumber"], ["quantity"], 2000).collect()}
    assert set(cuts) == set(hot) and len(hot) > 5
    for key, n in hot.items():
        assert len(cuts[key]) >= n // 2000
    plain = df.drop("__tie")
    split = numbering.occurrence_number(plain, ["l_linenumber"], ["quantity"], "n", hot_rows=2000)
    whole = numbering.occurrence_number(plain, ["l_linenumber"], ["quantity"], "n", hot_rows=None)
    assert split.exceptAll(whole).isEmpty() and whole.exceptAll(split).isEmpty()


def test_long_pattern_lists_give_the_rows_of_short_ones(spark, rows):
    rng = random.Random(4)
    words = ["ELEC", "GAS", "BILL", "BONUS", "MANUAL", "%", "_", "X", "LEASE", r"\_", r"\%"]
    listed = [("%", "%"), ("", ""), ("A%", "_"), ("%_BILL", "%"), (r"%\%%", "%")]
    listed += [("".join(rng.choice(words) for _ in range(rng.randint(1, 4))), rng.choice(["%", "a%", "%special%", ""])) for _ in range(1495)]
    data = [("_".join(rng.choice(["ELEC", "GAS", "BILL", "BONUS", "%", "X", ""]) for _ in range(rng.randint(1, 4))), rng.choice([None, "", "a", "abc", "a special b"])) for _ in range(300)]
    df = spark.createDataFrame(data + [(None, "a"), ("", ""), ("", "")], "g string, a string")
    columns = [F.col("g"), F.coalesce("a", F.lit(""))]
    def like(pattern):
        parts = re.findall(r"\\.|.", pattern)
        return re.compile("".join(".*" if p == "%" else "." if p == "_" else re.escape(p[-1]) for p in parts), re.S)

    compiled = [(like(g), like(a), g) for g, a in listed]
    expected, first = [], []
    for g, a in rows(df):
        hits = [p for x, y, p in compiled if g is not None and x.fullmatch(g) and y.fullmatch(a or "")]
        expected += [(g, a, p) for p in hits]
        first += [(g, a, hits[0])] if hits else []
    null_last = [[(v is None, v or "") for v in r] for r in sorted(expected, key=lambda r: [(v is None, v or "") for v in r])]
    found = patterns.pattern_join(df, columns, listed, "p")
    assert [[(v is None, v or "") for v in r] for r in rows(found)] == null_last
    once = patterns.pattern_join(df, columns, listed, "p", match_once=True)
    assert rows(once) == sorted(first, key=lambda r: [(v is None, v or "") for v in r])
    assert rows(patterns.keep_matching(df, columns, listed)) == rows(df.filter(F.col("g").isNotNull()))
    assert patterns.anchor("%_BILL%") == "BIL" and patterns.anchor(r"a\_bcd%") == "bcd" and patterns.anchor("%a_b%") == ""


def test_key_total(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 5), (None, 1)], "k string, v int")
    assert rows(numbering.key_total(df, ["k"], "v", "t")) == [
        ("a", "1", "3"), ("a", "2", "3"), (None, "1", "6"), (None, "5", "6"),
    ]


def test_shapes(spark, rows):
    df = spark.createDataFrame([(1, "x", "p", "v1"), (1, "y", "q", "v2"), (2, "z", "p", "v3")], "id int, t string, k string, v string")
    pivoted = shape.pivot_attributes(df, "id", "k", "v", ["p", "q"], F.col("t") != "z")
    assert rows(pivoted) == [("1", "v1", "v2"), ("2", None, None)]
    layout = shape.layout("b string, a decimal(20,2)")
    out = shape.conform_union([spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([("t",)], "b string")], layout)
    assert out.columns == ["b", "a"] and out.count() == 2


def test_propagate_levels_and_bound(spark, rows):
    known = spark.createDataFrame([("t1", 5)], "k string, v int")
    links = spark.createDataFrame(
        [(f"t{i}", f"t{i - 1}") for i in range(2, 9)] + [("t9", "unknown"), ("t3", "t1")], "k string, p string"
    )
    got = propagate(known, links, "k", "p", "v", 6)
    # t3 points at t1 too, so everything after it is one level nearer
    assert rows(got) == [(f"t{i}", "5") for i in range(2, 9)]
    nothing = propagate(known, links.filter("k = 't9'"), "k", "p", "v", 6)
    assert nothing.isEmpty()


def test_propagate_without_a_bound(spark, rows):
    known = spark.createDataFrame([("t0", 5)], "k string, v int")
    chain = [(f"t{i}", f"t{i - 1}") for i in range(1, 10)] + [("a", "t2"), ("a", "b"), ("b", "a"), ("c", "d"), ("d", "c")]
    links = spark.createDataFrame(chain, "k string, p string")
    assert len(rows(propagate(known, links, "k", "p", "v", 2))) == 2
    assert rows(propagate(known, links, "k", "p", "v", None)) == sorted([(f"t{i}", "5") for i in range(1, 10)] + [("a", "5"), ("b", "5")])
    assert propagate(known, links, "k", "p", "v", 0).isEmpty()
