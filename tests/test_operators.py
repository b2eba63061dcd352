"""Operators: golden cases, ties, late rows, duplicate matches."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from brokerdw.operators import checks, grouping, hotkeys, joins, merge, rolling, sketch, temporal

D, T = date.fromisoformat, datetime.fromisoformat
END = D("9999-12-31")


def tuples(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture
def customer(spark):
    rows = [
        (1, T("2007-01-05T10:00"), "Active", "Li", 1, "X"),
        (1, T("2007-03-01T09:00"), "Active", None, 2, None),
        (1, T("2007-03-01T17:00"), "Active", None, None, "Y"),
        (1, T("2008-01-01T00:00"), "Inactive", None, None, None),
    ]
    df = spark.createDataFrame(rows, "id int, ts timestamp, status string, name string, tier int, city string")
    return temporal.scd2_history(temporal.forward_fill(df, "id", "ts", ["name", "tier", "city"]), "id", "ts")


def test_forward_fill_and_history(customer):
    got = tuples(customer, "effectivedate", "enddate", "name", "tier", "city", "status", "iscurrent")
    assert got == [
        (D("2007-01-05"), D("2007-03-01"), "Li", 1, "X", "Active", False),
        (D("2007-03-01"), D("2008-01-01"), "Li", 2, "Y", "Active", False),
        (D("2008-01-01"), END, "Li", 2, "Y", "Inactive", True),
    ]


def test_pit_join_boundaries(spark, customer):
    facts = spark.createDataFrame([(1, D("2007-01-04")), (1, D("2007-03-01")), (1, D("2008-01-01"))], "id int, d date")
    got = tuples(temporal.pit_join(facts, customer, "id", "d", dim_cols=["city", "status"]), "d", "city", "status")
    assert got == [(D("2007-03-01"), "Y", "Active"), (D("2008-01-01"), "Y", "Inactive")]


def test_interval_join_clips(spark, customer):
    account = spark.createDataFrame([(7, 1, D("2007-02-01"), END)], "acct int, id int, effectivedate date, enddate date")
    got = temporal.interval_join(account, customer, "id", "left", ["status"])
    assert tuples(got, "effectivedate", "enddate", "iscurrent") == [
        (D("2007-02-01"), D("2007-03-01"), False),
        (D("2007-03-01"), D("2008-01-01"), False),
        (D("2008-01-01"), END, True),
    ]


def test_running_balance(spark):
    rows = [(7, T("2020-01-01T01:00"), 100.0), (7, T("2020-01-01T02:00"), 50.0), (7, T("2020-01-02T01:00"), -30.0)]
    df = spark.createDataFrame(rows, "a int, t timestamp, v double")
    got = tuples(rolling.running_balance(df, "a", "t", "v"), "datevalue", "cash")
    assert got == [(D("2020-01-01"), 150.0), (D("2020-01-02"), 120.0)]


def test_rolling_extremes_earliest_on_tie(spark):
    rows = [("s", D(f"2020-01-0{i}"), float(v)) for i, v in enumerate([5, 4, 4, 6], 1)]
    df = spark.createDataFrame(rows, "k string, d date, v double")
    got = tuples(rolling.rolling_extremes(df, "k", ["d"], "v", "v", 1), "d", "low_value", "low_date", "high_value", "high_date")
    day = lambda n: D(f"2020-01-0{n}")
    assert [r[1:3] for r in got] == [(5.0, day(1)), (4.0, day(2)), (4.0, day(2)), (4.0, day(3))]
    assert [r[3:] for r in got] == [(5.0, day(1)), (5.0, day(1)), (4.0, day(2)), (6.0, day(4))]


def test_trailing_sum(spark):
    df = spark.createDataFrame([("k", i, float(i)) for i in range(1, 7)], "k string, o int, v double")
    got = tuples(rolling.trailing_sum(df, "k", ["o"], "v"), "o", "trailing_sum")
    assert [r[1] for r in got] == [None, 1.0, 3.0, 6.0, 10.0, 14.0]


def test_first_last_seen(spark):
    rows = [("a", "R1", 1), ("a", "R1", 2), ("a", "R2", 3), ("b", "R1", 1)]
    seen = grouping.first_last_seen(spark.createDataFrame(rows, "k string, r string, batchid int"))
    assert tuples(seen, "k", "r", "batchid", "recordbatchid") == [("a", "R1", 1, 2), ("a", "R2", 3, 3), ("b", "R1", 1, 1)]
    assert tuples(grouping.snapshot_as_of(seen, 2), "k", "r") == [("a", "R1")]
    assert tuples(grouping.snapshot_as_of(seen, 3), "k", "r") == [("a", "R2")]


def test_placed_removed(spark):
    rows = [(1, "A", 1, "ACTV"), (1, "A", 5, "CNCL"), (1, "B", 2, "ACTV"), (2, "A", 3, "CNCL")]
    df = spark.createDataFrame(rows, "c int, s string, t int, a string")
    got = grouping.placed_removed(df, ["c", "s"], "t", "a")
    assert tuples(got, "c", "s", "placed", "removed") == [(1, "A", 1, 5), (1, "B", 2, None), (2, "A", None, 3)]
    whole = grouping.placed_removed(df, ["c", "s"], "t", "a", ignore_cancel=False)
    assert (2, "A", 3, 3) in tuples(whole, "c", "s", "placed", "removed")


TARGET = "id bigint, v string, effectivedate date, enddate date, iscurrent boolean"


def test_scd2_merge(spark):
    target = spark.createDataFrame([(1, "a", D("2020-01-01"), END, True)], TARGET)
    source = spark.createDataFrame([(1, "b", D("2020-02-01")), (2, "c", D("2020-02-01"))], "id bigint, v string, effectivedate date")
    got = merge.scd2_merge(target, source, ["id"])
    assert tuples(got.closed, "id", "v", "enddate", "iscurrent") == [(1, "a", D("2020-02-01"), False)]
    assert tuples(got.current, "id", "v", "effectivedate", "enddate") == [(1, "b", D("2020-02-01"), END), (2, "c", D("2020-02-01"), END)]


def test_scd2_merge_keeps_previous_values_and_inplace(spark):
    target = spark.createDataFrame([(1, "a", D("2020-01-01"), END, True), (3, "x", D("2020-01-01"), END, True)], TARGET)
    source = spark.createDataFrame([(1, None, D("2020-02-01"))], "id bigint, v string, effectivedate date")
    fix = spark.createDataFrame([(3, "y"), (1, "z")], "id bigint, v string")
    got = merge.scd2_merge(target, source, ["id"], ["v"], inplace=fix, inplace_cols=["v"])
    assert tuples(got.current, "id", "v") == [(1, "a"), (3, "y")]


def test_merge_rejects_two_matches(spark):
    target = spark.createDataFrame([(1, "a")], "id int, v string")
    source = spark.createDataFrame([(1, "b"), (1, "c")], "id int, v string")
    merged = merge.merge(target, source, ["id"], matched=[(None, {"v": F.col("s_v")})])
    with pytest.raises(Exception, match="several source rows match"):
        merged.collect()


def test_merge_allows_duplicates_that_do_not_match(spark):
    target = spark.createDataFrame([(1, "a")], "id int, v string")
    source = spark.createDataFrame([(2, "b"), (2, "c"), (None, "d")], "id int, v string")
    got = merge.merge(target, source, ["id"], matched=[(None, {"v": F.col("s_v")})])
    assert tuples(got, "id", "v") == sorted([(1, "a"), (2, "b"), (2, "c"), (None, "d")], key=repr)


def test_merge_clause_order(spark):
    target = spark.createDataFrame([(1, 1, 0), (2, 2, 0), (3, 3, 0)], "id int, v int, w int")
    source = spark.createDataFrame([(1, 10, 0), (2, 20, 0)], "id int, v int, w int")
    clauses = [(F.col("s_v") > 15, {"v": F.col("s_v")}), (None, {"w": F.lit(9)})]
    got = merge.merge(target, source, ["id"], matched=clauses, insert=False)
    assert tuples(got, "id", "v", "w") == [(1, 1, 9), (2, 20, 0), (3, 3, 0)]


def test_name_match_is_null_safe_on_second_line(spark):
    left = spark.createDataFrame([(1, "Li", None), (2, "Li", "x"), (3, None, None)], "id int, n string, l string")
    right = spark.createDataFrame([("LI", "", "hit")], "n string, l string, tag string")
    assert tuples(joins.name_match_join(left, right, ["n"], ["l"]), "id", "tag") == [(1, "hit"), (2, None), (3, None)]


def test_union_key_join_matches_once(spark):
    left = spark.createDataFrame([("7",), ("acme",)], "ref string")
    right = spark.createDataFrame([(7, "7", "both"), (8, "acme", "name")], "id int, name string, tag string")
    got = temporal.union_key_join(left, right, "ref", ["name", "id"], ["tag"])
    assert tuples(got, "ref", "tag") == [("7", "both"), ("acme", "name")]


def test_checks(spark):
    df = spark.createDataFrame([(1, 5), (1, 6), (2, None), (None, 7)], "k int, r int")
    assert tuples(checks.check_unique(df, ["k"]), "k", "rows") == [(1, 2), (None, 1)]
    parent = spark.createDataFrame([(5,), (7,)], "id int")
    assert tuples(checks.check_fk(df, parent, [("r", "id")]), "k", "r") == [(1, 6)]
    assert tuples(checks.expect(df, {"small": F.col("r") < 7}), "rule", "passed", "failed") == [("small", 2, 2)]


def test_overlapping_versions(spark):
    rows = [(1, D("2020-01-01"), D("2020-03-01")), (1, D("2020-02-01"), END), (2, D("2020-01-01"), END)]
    df = spark.createDataFrame(rows, "k int, effectivedate date, enddate date")
    assert tuples(checks.overlapping_versions(df, ["k"]), "k") == [(1,)]


def test_overlaps_are_counted_as_pairs(spark):
    rng = random.Random(7)
    spans = [(rng.choice([1, 2, None]), s, s + rng.choice([0, 1, 5, 40])) for s in (rng.randrange(60) for _ in range(300))]
    spans += [(3, 0, 100), (3, 10, 90), (3, 20, 80), (3, 100, 110), (4, 5, 9), (5, 1, 1)]
    day = lambda c: F.date_add(F.lit("2020-01-01").cast("date"), F.col(c))
    df = spark.createDataFrame(spans, "k int, s int, e int").select("k", day("s").alias("effectivedate"), day("e").alias("enddate"))
    want = {}
    for i, (k, s, e) in enumerate(spans):
        want[k] = want.get(k, 0) + sum(1 for j, (x, a, b) in enumerate(spans) if i != j and x == k and a <= s < b)
    assert want[3] == 3 and want[4] == want[5] == 0
    for hot in (hotkeys.NO_HOT, hotkeys.find_hot_keys(df, ["k"], 60)):
        assert {r["k"]: r["pairs"] for r in checks.overlap_counts(df, ["k"], hot=hot).collect()} == want


@pytest.mark.parametrize("most", [sketch.MOST_WORDS, 1])
def test_lost_references_are_found_without_shuffling_the_child(spark, monkeypatch, most):
    monkeypatch.setattr(sketch, "MOST_WORDS", most)
    n = F.col("id")
    child = spark.range(40_000).select((n % 500).alias("a"), F.when(n % 9 > 0, (n % 7).cast("string")).alias("b"), n.alias("row"))
    parent = spark.range(3500).select((n % 500).alias("x"), (n % 7).cast("string").alias("y")).filter("x % 50 <> 3 OR y <> '2'")
    want = child.filter("a % 50 = 3 AND b = '2'").count()
    found = checks.check_fk(child, parent, [("a", "x"), ("b", "y")])
    rows = found.collect()
    assert len(rows) == want > 50 and all(r["a"] % 50 == 3 and r["b"] == "2" for r in rows) and found.columns == child.columns
    whole = checks.check_fk(child, child.select("a", "b"), [("a", "a"), ("b", "b")])
    assert whole.count() == 0


def test_a_sketch_holds_its_keys_and_few_others(spark):
    keys = spark.range(3000).select(F.xxhash64("id").alias("k"))
    words = sketch.words_for(3000)
    df = spark.range(30_000).select(F.xxhash64("id").alias("k"), "id")
    passed = sketch.may_hold(df, ["k"], keys, words)
    assert passed.filter("id < 3000").count() == 3000 and passed.count() < 3000 + 600
    plan = passed._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan.split("Subquery")[0]
    assert sketch.words_for(0) == 1 and sketch.words_for(10**9) is None
