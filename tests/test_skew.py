"""Cut keys give the same results as plain windows and joins, however skewed the data."""

import random

import pytest
from pyspark.sql import functions as F

from brokerdw.operators import hotkeys, rolling, temporal


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 rows, a third of them of one key, a tenth of a null key; values have gaps."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 1).when(n % 10 == 1, F.lit(None)).otherwise(2 + n % 50)
    day = F.date_add(F.lit("2020-01-01").cast("date"), ((n * n) % 700).cast("int"))
    rows = spark.range(3000).select(
        key.cast("int").alias("k"), day.alias("d"), n.alias("o"), F.when(n % 7 == 0, (n * 37 % 1000).cast("double")).alias("v")
    )
    return rows.persist()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def hot(df, limit=40):
    found = hotkeys.find_hot_keys(df, ["k"], limit)
    assert found and found.has_null
    return found


def test_forward_fill(skewed):
    plain = temporal.forward_fill(skewed, "k", ["d", "o"], ["v"], hotkeys.NO_HOT)
    assert rows(temporal.forward_fill(skewed, "k", ["d", "o"], ["v"], hot(skewed))) == rows(plain)


@pytest.mark.parametrize("preceding, following", [(4, 0), (0, 1), (3, 2)])
def test_bounded_window(skewed, preceding, following):
    exprs = {"s": lambda w: F.sum("v").over(w.rowsBetween(-preceding, following)), "n": lambda w: F.lead("o").over(w)}
    reach = {"preceding": preceding, "following": max(following, 1)}
    plain = hotkeys.bounded_window(skewed, ["k"], ["d", "o"], exprs, hot=hotkeys.NO_HOT, **reach)
    cut = hotkeys.bounded_window(skewed, ["k"], ["d", "o"], exprs, hot=hot(skewed), block_rows=25, **reach)
    assert rows(cut) == rows(plain)


def test_positions(skewed):
    numbered = hotkeys.row_positions(skewed, ["k"], ["d", "o"], hot(skewed))
    per_key = numbered.groupBy("k").agg(F.min("_pos"), F.max("_pos"), F.count("*"), F.countDistinct("_pos")).collect()
    assert all(r[1] == 1 and r[2] == r[3] == r[4] for r in per_key)


def test_rolling_extremes(skewed):
    df = skewed.withColumn("v", F.coalesce("v", F.col("o").cast("double")))
    plain = rolling.rolling_extremes(df, "k", ["d", "o"], "v", "v", 30, hotkeys.NO_HOT)
    assert rows(rolling.rolling_extremes(df, "k", ["d", "o"], "v", "v", 30, hot(df))) == rows(plain)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_point_in_time_join(skewed, how):
    versions = temporal.scd2_history(skewed.select("k", "d", F.col("o").alias("version")), "k", "d", "version")
    plain = temporal.pit_join(skewed, versions, "k", "d", how, ["version"], hotkeys.NO_HOT)
    marks = temporal.many_versions(versions, ["k"], 20)
    assert rows(temporal.pit_join(skewed, versions, "k", "d", how, ["version"], marks)) == rows(plain)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join(skewed, how):
    history = lambda rest, name: temporal.scd2_history(
        skewed.filter(F.col("o") % 5 == rest).select("k", "d", F.col("o").alias(name)), "k", "d", name
    ).select("k", name, "effectivedate", "enddate")
    a, b = history(1, "a"), history(2, "b")
    plain = temporal.interval_join(a, b, "k", how, ["b"], hotkeys.NO_HOT)
    marks = temporal.many_versions(a.select("k").union(b.select("k")), ["k"], 20)
    assert marks
    assert rows(temporal.interval_join(a, b, "k", how, ["b"], marks)) == rows(plain)


def test_configured_limit_cuts_keys(spark, skewed):
    plain = rows(temporal.forward_fill(skewed, "k", ["d", "o"], ["v"], hotkeys.NO_HOT))
    spark.conf.set("brokerdw.hotRows", "40")
    try:
        df = temporal.forward_fill(skewed, "k", ["d", "o"], ["v"])
        assert hotkeys.CELL in df._jdf.queryExecution().toString()
        assert rows(df) == plain
    finally:
        spark.conf.unset("brokerdw.hotRows")


def test_no_cross_joins_and_bounded_broadcast(skewed):
    versions = temporal.scd2_history(skewed.select("k", "d", F.col("o").alias("version")), "k", "d", "version")
    marks = temporal.many_versions(versions, ["k"], 20)
    plan = temporal.pit_join(skewed, versions, "k", "d", "inner", ["version"], marks)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_many_hot_keys_bursts_and_undated_rows(spark):
    """2000 keys above the limit, a burst of one key on one day, rows without a date: as in the plain plan."""
    n = F.col("id")
    many = spark.range(0, 20_000).select((n % 2000).alias("k"), F.date_add(F.lit("2020-01-01").cast("date"), (n / 2000).cast("int")).alias("d"), n.alias("o"))
    burst = spark.range(20_000, 25_000).select(F.lit(-1).cast("long").alias("k"), F.lit("2020-03-01").cast("date").alias("d"), n.alias("o"))
    undated = spark.range(25_000, 26_000).select(F.lit(-1).cast("long").alias("k"), F.lit(None).cast("date").alias("d"), n.alias("o"))
    df = many.union(burst).union(undated).withColumn("v", F.when(F.col("o") % 7 == 0, F.col("o"))).persist()
    marks = hotkeys.find_hot_keys(df, ["k"], 5)
    assert marks.count == 2001
    cells = hotkeys.with_cells(df.filter("k = -1"), ["k"], ["d", "o"], hotkeys.find_hot_keys(df, ["k"], 100))
    assert cells.groupBy("_cell").count().agg(F.max("count")).first()[0] <= 2 * 26_000 // hotkeys.FEW_CELLS
    plain = temporal.forward_fill(df, "k", ["d", "o"], ["v"], hotkeys.NO_HOT)
    assert rows(temporal.forward_fill(df, "k", ["d", "o"], ["v"], marks)) == rows(plain)
    next_rows = {"x": lambda w: F.lead("o").over(w)}
    plain = hotkeys.bounded_window(df, ["k"], ["d", "o"], next_rows, following=1, hot=hotkeys.NO_HOT)
    cut = hotkeys.bounded_window(df, ["k"], ["d", "o"], next_rows, following=1, hot=marks, block_rows=9)
    assert rows(cut) == rows(plain)


def test_left_interval_join_keeps_rows_with_equal_starts(spark):
    """Left rows of one key and start, some without a partner, some repeated."""
    left = [(1, x, f"2020-01-{d:02d}", f"2020-01-{d + w:02d}") for d in range(1, 20) for x, w in ((0, 1), (1, 3), (1, 3), (2, 9))]
    right = [(1, 7, f"2020-01-{d:02d}", f"2020-01-{d + 1:02d}") for d in range(3, 28, 6)]
    dated = lambda rows_, name: spark.createDataFrame(rows_, f"k int, {name} int, s string, e string").select(
        "k", name, F.to_date("s").alias("effectivedate"), F.to_date("e").alias("enddate")
    )
    a, b = dated(left, "a"), dated(right, "b")
    plain = temporal.interval_join(a, b, "k", "left", ["b"], hotkeys.NO_HOT)
    cut = temporal.interval_join(a, b, "k", "left", ["b"], temporal.many_versions(a.select("k").union(b.select("k")), ["k"], 4))
    assert rows(cut) == rows(plain) and len(rows(plain)) > 60


def overlapping(spark, seed, name, n=400):
    """Versions of three keys and of null, long and short, many over each other, with equal starts, empty and repeated ones."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        start = rng.choice([rng.randrange(300), 60])
        out.append((rng.choice([1, 1, 1, 2, 3, None]), i, start, start + rng.choice([0, 1, 2, 7, 40, 200, 2_900_000])))
    out += out[:20]
    day = lambda c: F.date_add(F.lit("1969-11-01").cast("date"), F.col(c))
    rows_ = spark.createDataFrame(out, f"k int, {name} int, s int, e int")
    return rows_.select("k", name, day("s").alias("effectivedate"), day("e").alias("enddate")).persist()


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("rows_per_task", [None, 50])
def test_sweeps_over_overlapping_versions(spark, how, rows_per_task):
    a, b = overlapping(spark, 1, "a"), overlapping(spark, 2, "b")
    facts = spark.range(900).select(
        F.when(F.col("id") % 11 > 0, F.col("id") % 4).cast("int").alias("k"),
        F.when(F.col("id") % 13 > 0, F.date_add(F.lit("1969-10-01").cast("date"), (F.col("id") % 400).cast("int"))).alias("d"),
        F.col("id").alias("o"),
    )
    facts = facts.union(facts.limit(30))
    marks = temporal.many_versions(a.select("k").union(b.select("k")), ["k"], 100)
    assert marks.count == 3
    if rows_per_task:
        spark.conf.set("brokerdw.hotRows", str(rows_per_task))
    try:
        plain = temporal.pit_join(facts, a, "k", "d", how, ["a"], hotkeys.NO_HOT)
        assert rows(temporal.pit_join(facts, a, "k", "d", how, ["a"], marks)) == rows(plain)
        plain = rows(temporal.interval_join(a, b, "k", how, ["b"], hotkeys.NO_HOT))
        assert rows(temporal.interval_join(a, b, "k", how, ["b"], marks)) == plain and len(plain) > 1000
    finally:
        spark.conf.unset("brokerdw.hotRows")


def test_days_are_cut_into_whole_blocks(spark):
    intervals = [(0, 1), (5, 6), (1, 8), (0, 8), (3, 13), (4194304, 7124773), (6, 6)]
    cut = spark.createDataFrame(intervals, "_s int, _e int").select("_s", "_e", temporal._blocks(F.col("_s"), F.col("_e")).alias("b"))
    for r in cut.collect():
        spans = sorted((x["b"] << x["l"], (x["b"] + 1) << x["l"]) for x in r["b"])
        at = r["_s"]
        for start, end in spans:
            assert start == at
            at = end
        assert at == r["_e"] or r["_s"] == r["_e"] and not spans
        assert len(spans) <= 46


def test_a_key_with_a_million_versions(spark):
    """The sweep compares no fact with a version that is not open on its day; plain equality would form 10**11 pairs."""
    n = 1_000_000
    first, key = F.lit("0001-01-02").cast("date"), (F.col("id") % 1 + 7).alias("k")
    versions = spark.range(n).select(
        key, F.col("id").alias("v"), F.date_add(first, F.col("id").cast("int")).alias("effectivedate"),
        F.date_add(first, (F.col("id") + F.when(F.col("id") % 10 == 0, 0).otherwise(1)).cast("int")).alias("enddate"),
    )
    facts = spark.range(100_000).select(key, F.date_add(first, (F.col("id") * 10 + F.col("id") % 2).cast("int")).alias("d"), F.col("id").alias("o"))
    spark.conf.set("brokerdw.hotRows", "100000")
    try:
        joined = temporal.pit_join(facts, versions, "k", "d", "left", ["v"])
        got = joined.agg(F.count("*"), F.count("v"), F.count_if(F.col("v") == F.col("o") * 10 + 1)).first()
        plan = joined._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("brokerdw.hotRows")
    assert tuple(got) == (100_000, 50_000, 50_000)
    assert "collect_list" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_counting_is_done_once_and_writes_nothing_without_hot_keys(spark, skewed, monkeypatch):
    calls = []
    monkeypatch.setattr(hotkeys, "scratch_dir", lambda *a: calls.append(a))
    df = skewed.select("k", "d", F.lit(1).alias("only here"))
    assert hotkeys.find_hot_keys(df, ["k"], 5000) is hotkeys.NO_HOT and not calls
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("again", "again")
    hotkeys.find_hot_keys(df, ["k"], 5000)
    assert not jobs.getJobIdsForGroup("again")
    spark.sparkContext.setJobGroup("", "")
