"""Automatic change application: late rows, repeated rows, nulls."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from brokerdw.sources import scans
from brokerdw.sources.store import TableStore
from brokerdw.streaming import cdc

T = datetime.fromisoformat


def tuples(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def batches(spark, rows, schema):
    return [spark.createDataFrame([r], schema) for r in rows]


def test_type1_out_of_order_ignoring_nulls(spark):
    rows = [(1, 1, "x1", None), (1, 3, "x3", None), (1, 2, "x2", "y9")]
    state = None
    for b in batches(spark, rows, "k int, s int, x string, y string"):
        state = cdc.apply_changes_scd1(state, b, ["k"], "s", except_cols=["s"])
    assert tuples(cdc.scd1_view(state, ["k"]), "k", "x", "y") == [(1, "x3", "y9")]


def test_type1_nulls_count_when_not_ignored(spark):
    rows = [(1, 1, "a"), (1, 2, None)]
    state = None
    for b in batches(spark, rows, "k int, s int, x string"):
        state = cdc.apply_changes_scd1(state, b, ["k"], "s", ignore_nulls=False, except_cols=["s"])
    assert tuples(cdc.scd1_view(state, ["k"]), "k", "x") == [(1, None)]


def test_type2_late_row_splits_an_interval(spark):
    rows = [(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (1, 2, "b")]
    state = None
    for b in batches(spark, rows, "k int, s int, x string"):
        state = cdc.apply_changes_scd2(state, b, ["k"], "s")
    got = tuples(cdc.scd2_view(state, ["k"]), "x", "__START_AT", "__END_AT")
    assert got == [("a", 1, 2), ("b", 2, 3), ("c", 3, None)]


def test_type2_fills_missing_values_from_the_version_before(spark):
    rows = [(1, 1, "a", "q"), (1, 3, None, "r"), (1, 2, "b", None)]
    state = None
    for b in batches(spark, rows, "k int, s int, x string, y string"):
        state = cdc.apply_changes_scd2(state, b, ["k"], "s")
    assert tuples(cdc.scd2_view(state, ["k"]), "__START_AT", "x", "y") == [(1, "a", "q"), (2, "b", "q"), (3, "b", "r")]


def test_stream_restarts_where_it_stopped(spark, tmp_path):
    """New files are picked up once; a second run without new files changes nothing."""
    folder = tmp_path / "in"
    folder.mkdir()
    store = TableStore(spark, str(tmp_path / "store"))
    schema = "k INT, s INT, x STRING"
    to_log = lambda df: cdc.scd1_log(df, ["k"], "s", True, ["s"])

    def drain(once=None):
        stream = scans.stream_delimited(spark, str(folder), schema)
        cdc.run_cdc(stream, store, "t", to_log, str(tmp_path / "checkpoint"), once)

    (folder / "a.txt").write_text("1|5|new\n2|1|two\n")
    history = spark.createDataFrame([(1, 1, "old"), (3, 1, "three")], schema)
    drain(history)
    assert tuples(cdc.scd1_view(store.read("t"), ["k"]), "k", "x") == [(1, "new"), (2, "two"), (3, "three")]
    parts = len(store.parts("t"))
    drain(history)
    assert len(store.parts("t")) == parts
    (folder / "b.txt").write_text("1|4|late\n3|2|changed\n")
    drain(history)
    assert tuples(cdc.scd1_view(store.read("t"), ["k"]), "k", "x") == [(1, "new"), (2, "two"), (3, "changed")]
    store.compact("t", lambda df: cdc.combine_scd1(df, ["k"]))
    assert len(store.parts("t")) == 1
    assert tuples(cdc.scd1_view(store.read("t"), ["k"]), "k", "x") == [(1, "new"), (2, "two"), (3, "changed")]


def test_rows_of_equal_sequence_are_not_mixed(spark):
    """One of the rows wins as a whole, in whatever order and grouping they come."""
    rows = [(1, 5, "a", "z"), (1, 5, "b", "y"), (1, 5, "c", None), (2, 1, None, "q"), (2, 1, "p", None)]
    for order in (rows, rows[::-1]):
        for whole in (True, False):
            parts = [spark.createDataFrame(order, "k int, s int, x string, y string")] if whole else batches(spark, order, "k int, s int, x string, y string")
            one = two = None
            for b in parts:
                one = cdc.apply_changes_scd1(one, b, ["k"], "s", ignore_nulls=False)
                two = cdc.apply_changes_scd2(two, b, ["k"], "s")
            got = tuples(cdc.scd1_view(one, ["k"]), "k", "s", "x", "y")
            assert all(r in rows for r in got) and len(got) == 2
            assert tuples(cdc.scd2_view(two, ["k"], ignore_nulls=False), "k", "__START_AT", "x", "y") == got


def test_new_checkpoint_loses_nothing(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    schema = "k INT, s INT, x STRING"
    for n in (1, 2):
        folder = tmp_path / f"in{n}"
        folder.mkdir()
        (folder / "f.txt").write_text(f"{n}|1|v{n}\n")
        stream = scans.stream_delimited(spark, str(folder), schema)
        cdc.run_cdc(stream, store, "t", lambda df: cdc.scd1_log(df, ["k"], "s"), str(tmp_path / f"check{n}"))
    assert tuples(cdc.scd1_view(store.read("t"), ["k"]), "k", "x") == [(1, "v1"), (2, "v2")]


def test_a_micro_batch_opens_the_buckets_of_its_keys_only(spark, tmp_path):
    """After the first load all buckets but those of the changed keys are unreadable."""
    folder = tmp_path / "in"
    folder.mkdir()
    store = TableStore(spark, str(tmp_path / "store"))
    schema = "k INT, s INT, x STRING"
    by = cdc.ByKey(["k"], cdc.combine_scd2, cdc.scd2_view, 16)
    history = [(k, s, f"{k}-{s}") for k in range(200) for s in (1, 5)]

    def drain():
        stream = scans.stream_delimited(spark, str(folder), schema)
        cdc.run_cdc(stream, store, "t", lambda df: cdc.scd2_log(df, ["k"], "s"), str(tmp_path / "checkpoint"), spark.createDataFrame(history, schema), by=by)

    def seen(table):
        return tuples(table, "k", "__START_AT", "__END_AT", "x")

    (folder / "a.txt").write_text("")
    drain()
    assert len(store.parts("t")) == len(store.parts("t_view")) == 16
    changes = [(7, 3, "late"), (7, 9, "new"), (300, 1, "first")]
    touched = set(store.buckets_of(spark.createDataFrame(changes, schema), ["k"], 16))
    want = seen(cdc.scd2_view(cdc.scd2_log(spark.createDataFrame(history + changes, schema), ["k"], "s"), ["k"]))
    kept = {}
    for name in ("t", "t_view"):
        for part in store.parts(name):
            for path in [] if part["label"] in touched else Path(part["path"]).glob("*.parquet"):
                kept[path] = path.read_bytes()
                path.write_bytes(b"not readable")
                path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    assert 0 < len(touched) < 4 and len(kept) >= 24
    (folder / "b.txt").write_text("".join(f"{k}|{s}|{x}\n" for k, s, x in changes))
    drain()
    for path, data in kept.items():
        path.write_bytes(data)
    spark.catalog.clearCache()
    assert seen(store.read("t_view")) == want
    commits = len(store.commits("t"))
    drain()
    assert len(store.commits("t")) == commits


def test_a_merge_stopped_between_log_and_view_is_taken_up(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    by = cdc.ByKey(["k"], cdc.combine_scd1, cdc.scd1_view, 4)
    log = lambda rows: cdc.scd1_log(spark.createDataFrame(rows, "k int, s int, x string"), ["k"], "s", True, ["s"])
    cdc.merge_log(store, "t", log([(1, 1, "a"), (2, 1, "b")]), by, "one")
    failing = cdc.ByKey(["k"], cdc.combine_scd1, lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")), 4)
    with pytest.raises(RuntimeError):
        cdc.merge_log(store, "t", log([(1, 2, "c"), (3, 1, "d")]), failing, "two")
    for _ in range(2):
        cdc.merge_log(store, "t", log([(1, 2, "c"), (3, 1, "d")]), by, "two")
    assert tuples(store.read("t_view"), "k", "x") == [(1, "c"), (2, "b"), (3, "d")]


def test_a_merge_opens_the_buckets_of_its_keys_only(spark, tmp_path):
    """Other buckets and the final rows are unreadable while a batch is merged; a repeated batch changes nothing."""
    from brokerdw.operators import merge

    store, final = TableStore(spark, str(tmp_path)), F.col("v") < 0
    rows = spark.range(300).select("id", F.when(F.col("id") % 10 == 0, -1).otherwise(1).alias("v"))
    store.replace_buckets("t", rows, ["id"], store.buckets_of(rows, ["id"], 16), "first", 16, final)
    source = spark.createDataFrame([(7, 5), (8, -5), (1000, 9), (1001, -9)], "id long, v int")

    def plan(target, batch):
        return merge.merge(target, batch, ["id"], matched=[(None, {"v": F.col("s_v")})])

    touched = set(store.buckets_of(source, ["id"], 16))
    kept = {}
    for part in store.parts("t"):
        for path in [] if part["label"] in touched else Path(part["path"]).glob("*.parquet"):
            kept[path] = path.read_bytes()
            path.write_bytes(b"not readable")
            path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    store.update_buckets("t", source, ["id"], plan, "one", 16, final)
    for path, data in kept.items():
        path.write_bytes(data)
    want = {r["id"]: r["v"] for r in rows.collect()} | {7: 5, 8: -5, 1000: 9, 1001: -9}
    got = store.read("t").collect()
    assert {r["id"]: r["v"] for r in got} == want and len(got) == len(want) and len(kept) > 12
    assert store.read("t", "final").count() == 32
    commits = len(store.commits("t"))
    store.update_buckets("t", source, ["id"], plan, "one", 16, final)
    assert len(store.commits("t")) == commits


def test_a_bucket_can_become_empty(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    rows = spark.range(20).select("id")
    store.replace_buckets("t", rows, ["id"], store.buckets_of(rows, ["id"], 4), "first", 4)
    gone = rows.filter("id < 10")
    store.update_buckets("t", gone, ["id"], lambda t, s: t.join(s, "id", "left_anti"), "two", 4)
    assert sorted(r["id"] for r in store.read("t").collect()) == list(range(10, 20))
    assert store.update_buckets("t", rows, ["id"], lambda t, s: t.limit(0), "three", 4).count() == 0
    assert store.update_buckets("t", rows.limit(3), ["id"], lambda t, s: t.unionByName(s), "four", 4).count() == 3
