"""Work that must follow the size of the tables: micro-batches, stored histories, plans."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from brokerdw.catalog import change_queries, derived, join_queries
from brokerdw.plans import audit
from brokerdw.sources import scans
from brokerdw.sources.store import TableStore
from brokerdw.streaming import cdc


def test_the_number_of_micro_batches_does_not_follow_the_number_of_files(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(minutes=i * 7 % 500), i % 11, "view", float(i)) for i in range(240)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double")
    events.repartition(6, "event_id").write.parquet(str(tmp_path / "events.parquet"))
    store = TableStore(spark, str(tmp_path / "store"))
    by = cdc.ByKey(["user_id"], cdc.combine_scd2, cdc.scd2_view, 4)
    to_log = lambda df: cdc.scd2_log(df, ["user_id"], "seq", ["event_id"])
    stream = change_queries._stream_files(spark, str(tmp_path), str(tmp_path / "in"))
    cdc.run_cdc(stream, store, "log", to_log, str(tmp_path / "checkpoint"), by=by)
    assert len(store.commits("log")) <= 3
    assert store.read("log_view").select("user_id", "__START_AT").distinct().count() == events.select("user_id", "ts").distinct().count()


def test_a_split_interval_join_reads_stored_histories(spark, tmp_path):
    line = spark.range(400).select(
        F.col("id").alias("l_orderkey"),
        (F.col("id") % 3).alias("l_suppkey"),
        (F.col("id") % 7 + 1).alias("l_linenumber"),
        F.timestamp_seconds(F.col("id") * 100000).alias("l_shipdate"),
    )
    line.write.parquet(str(tmp_path / "lineitem.parquet"))
    plain = join_queries._interval(spark, str(tmp_path), "left", 7)
    split = join_queries._interval(spark, str(tmp_path), "left", 7, limit=30)
    assert not [f for f in split.inputFiles() if "lineitem.parquet" in f]
    assert sorted(map(tuple, split.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_the_audit_collects_a_few_measures_at_a_time(spark, monkeypatch):
    together = []

    def counted(frames):
        together.append(len(frames))
        return scans.union_all(frames)

    monkeypatch.setattr(audit, "union_all", counted)
    rows = spark.range(3).select(F.lit(1).alias("batchid"), "id")
    measures = [audit.measure(rows, f"t{i}", {"rows": F.count(F.lit(1))}).withColumn("day", F.lit(None).cast("bigint")) for i in range(10)]
    found = audit.numbers(measures)
    assert [found.total(f"t{i}.rows") for i in range(10)] == [3] * 10
    assert sum(together) == 10 and max(together) <= audit.TOGETHER


def test_parts_are_stored_one_by_one(spark):
    parts = [spark.range(n).select("id", F.lit(n).alias("n")) for n in (2, 0, 3)]
    found = derived.stored_parts([parts[0], parts[1].select("n", "id"), parts[2]], "parts")
    assert sorted(map(tuple, found.collect())) == [(0, 2), (0, 3), (1, 2), (1, 3), (2, 3)]


def test_quotes_are_shuffled_once_unless_a_symbol_is_hot(spark, tmp_path):
    line = spark.range(600).select(
        F.col("id").alias("l_orderkey"),
        F.when(F.col("id") % 5 < 4, F.lit(7)).otherwise(F.col("id") % 3).alias("l_partkey"),
        (F.col("id") % 4).alias("l_linenumber"),
        F.timestamp_seconds(F.col("id") % 90 * 86400).alias("l_shipdate"),
        (F.col("id") * 37 % 101 / 4).alias("l_extendedprice"),
        (F.col("id") % 9).cast("double").alias("l_quantity"),
    )
    line.write.parquet(str(tmp_path / "lineitem.parquet"))
    once = derived.market_stage(spark, str(tmp_path))
    assert once._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    want = sorted(map(tuple, once.collect()), key=repr)
    spark.conf.set("brokerdw.hotRows", "50")
    try:
        cut = sorted(map(tuple, derived.market_stage(spark, str(tmp_path)).collect()), key=repr)
    finally:
        spark.conf.unset("brokerdw.hotRows")
    assert cut == want and len(want) == 90


def test_company_and_financial_records_come_from_one_count_of_the_lines(spark, tmp_path):
    line = spark.range(300).select(
        F.col("id").alias("l_orderkey"),
        (F.col("id") % 7).alias("l_partkey"),
        (F.col("id") % 3).alias("l_suppkey"),
        (F.col("id") % 5 / 100).alias("l_tax"),
        F.timestamp_seconds(F.col("id") * 200000).alias("l_shipdate"),
    )
    line.write.parquet(str(tmp_path / "lineitem.parquet"))
    supplier = [(i, f"Supplier {i}", i, 1.5) for i in range(3)]
    spark.createDataFrame(supplier, "s_suppkey long, s_name string, s_nationkey long, s_acctbal double").write.parquet(str(tmp_path / "supplier.parquet"))
    lines = derived.wire_lines(spark, str(tmp_path))
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_shipdate") and plan.count("quarter") and plan.count("Aggregate [") == 2
    kinds = {r["k"]: r["n"] for r in lines.groupBy(F.substring("value", 16, 3).alias("k")).agg(F.count("*").alias("n")).collect()}
    quarters = line.select("l_suppkey", F.date_trunc("quarter", "l_shipdate")).distinct().count()
    assert kinds["CMP"] == kinds["FIN"] == quarters and kinds["SEC"] == line.select("l_partkey", F.year("l_shipdate")).distinct().count()


def test_joins_store_keys_of_a_dimension_and_all_its_rows(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (1, "a", "y"), (None, "b", "z")], "k int, s string, rest string")
    kept = derived.stored_keys(rows, ["k", "s"], "keys")
    assert kept.columns == ["k", "s"] and sorted(map(tuple, kept.collect()), key=repr) == [(1, "a"), (1, "a"), (None, "b")]
    assert derived.warehouse(spark, "none", {"dimtrade": ["type"]}).columns == {"dimtrade": ["type"]}
