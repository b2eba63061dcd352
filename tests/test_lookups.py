"""Dimensions that grow are merged with the rows that look them up; Spark's estimate of a few of their columns is no bound."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from brokerdw.catalog import derived
from brokerdw.operators import hotkeys, temporal
from brokerdw.plans import audit, messages, stages

START, END = date(2020, 1, 1), date(9999, 12, 31)


@pytest.fixture(scope="module")
def dim(spark, tmp_path_factory):
    """300 companies with long texts that pack to nothing; two of them have no number."""
    path = str(tmp_path_factory.mktemp("dims") / "company")
    number = F.when(F.col("id") < 298, F.col("id"))
    rows = spark.range(300).select(
        number.alias("companyid"),
        number.alias("sk_companyid"),
        F.concat(F.lit("C"), F.col("id")).alias("name"),
        F.lit("text " * 40).alias("description"),
        F.lit(START).alias("effectivedate"),
        F.lit(END).alias("enddate"),
        (F.col("id") % 2 == 0).alias("iscurrent"),
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


def _facts(spark):
    return spark.range(400).select(
        F.when(F.col("id") < 390, F.col("id") % 310).alias("companyid"),
        F.col("id").cast("string").alias("ref"),
        F.lit(date(2021, 5, 5)).alias("day"),
        F.lit(START).alias("effectivedate"),
        F.lit(END).alias("enddate"),
        F.col("id").alias("o"),
    )


def _eps(spark, dim):
    financial = spark.range(400).select(
        (F.col("id") % 310).alias("sk_companyid"), F.date_add(F.lit(START), F.col("id").cast("int")).alias("fi_qtr_start_date"), F.lit(1.5).alias("fi_basic_eps")
    )
    return stages.company_eps_stage(financial, dim)


def _refs(spark, dim):
    tables = {
        "fact": _facts(spark).select(F.col("companyid").alias("sk_companyid"), F.lit(20210505).alias("d")),
        "dimdate": spark.createDataFrame([(20210505, "2021-05-05")], "sk_dateid int, datevalue string"),
        "dimcompany": dim,
    }
    return audit._valid_refs(tables, "Fact", {"company": ("DimCompany", "sk_companyid")}, "d")


def _joined(spark, dim):
    tables = {name.lower(): dim.limit(0) for name in messages.COUNTED}
    keys = {"sk_dateid": F.lit(1), "sk_securityid": F.col("companyid")}
    date_row = spark.createDataFrame([(1,)], "sk_dateid int")
    security = dim.select(F.col("companyid").alias("sk_securityid"))
    fact = _facts(spark).select(F.col("companyid").alias("sk_companyid"), *[v.alias(k) for k, v in keys.items()])
    return messages._joined({**tables, "factmarkethistory": fact, "dimdate": date_row, "dimcompany": dim, "dimsecurity": security}, "FactMarketHistory")


JOINS = {
    "pit": lambda s, d: temporal.pit_join(_facts(s), d, "companyid", "day", dim_cols=["sk_companyid"]),
    "pit left": lambda s, d: temporal.pit_join(_facts(s), d, "companyid", "day", "left", ["sk_companyid"]),
    "current": lambda s, d: temporal.current_join(_facts(s), d, "companyid", dim_cols=["sk_companyid"]),
    "interval": lambda s, d: temporal.interval_join(_facts(s), d, "companyid", "left", ["sk_companyid"]),
    "union": lambda s, d: temporal.union_key_join(_facts(s), d, "ref", ["companyid", "name"], ["sk_companyid"]),
    "union at": lambda s, d: temporal.union_key_join(_facts(s), d, "ref", ["companyid", "name"], ["sk_companyid"], at="day"),
    "union overlap": lambda s, d: temporal.union_key_join(_facts(s), d, "ref", ["companyid", "name"], ["sk_companyid"], overlap=True),
    "eps": _eps,
    "references": _refs,
    "joined counts": _joined,
}


@pytest.mark.parametrize("name", JOINS)
def test_a_long_dimension_is_merged_whatever_its_files_weigh(spark, dim, name):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    got = lambda df: sorted(map(tuple, df.collect()), key=repr)
    small = JOINS[name](spark, dim)
    want = got(small)
    assert "BroadcastHashJoin" in plan(small) and want
    spark.conf.set("brokerdw.lookupRows", "250")
    try:
        long = JOINS[name](spark, dim)
        shown = plan(long)
        assert "SortMergeJoin" in shown and got(long) == want
        # What is left to broadcast has a row: the days.
        assert shown.count("BroadcastHashJoin") <= (name in ("references", "joined counts"))
    finally:
        spark.conf.unset("brokerdw.lookupRows")


def test_rows_are_counted_once_with_the_hot_keys(spark, dim):
    hotkeys.find_hot_keys(dim.dropna(subset=["companyid"]), ["companyid"], 5)
    spark.sparkContext.setJobGroup("counted", "counted")
    known = hotkeys.row_count(dim.dropna(subset=["companyid"]), ["companyid"])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("counted")
    spark.sparkContext.setJobGroup("", "")
    assert known == 298 and not jobs
    assert hotkeys.row_count(dim) == 300 and hotkeys.row_count(dim.limit(0)) == 0


def test_orders_and_prospects_are_merged_when_they_are_many(spark, tmp_path, monkeypatch):
    day = F.timestamp_seconds(F.col("id") * 86400 * 5 + 700_000_000)
    tables = {
        "nation": spark.range(25).select(F.col("id").cast("int").alias("n_nationkey"), F.concat(F.lit("N"), F.col("id")).alias("n_name")),
        "customer": spark.range(20).select(
            F.col("id").alias("c_custkey"), F.concat(F.lit("C"), F.col("id")).alias("c_name"), (F.col("id") % 25).cast("int").alias("c_nationkey"),
            F.lit(1.5).alias("c_acctbal"), F.lit("SEG").alias("c_mktsegment"),
        ),
        "orders": spark.range(90).select(
            F.col("id").alias("o_orderkey"), (F.col("id") % 20).alias("o_custkey"), F.lit("F").alias("o_orderstatus"), day.alias("o_orderdate")
        ),
        "lineitem": spark.range(90).select(
            F.col("id").alias("l_orderkey"), F.col("id").alias("l_partkey"), F.col("id").alias("l_suppkey"), F.lit(2.0).alias("l_quantity"),
            F.lit(8.0).alias("l_extendedprice"), F.lit(0.1).alias("l_tax"), F.lit(0.1).alias("l_discount"),
        ),
    }
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    bases = []
    stored = derived.stored
    monkeypatch.setattr(derived, "stored", lambda df, *a: bases.append(plan(df)) or stored(df, *a))
    got = lambda: [sorted(map(tuple, f(spark, str(tmp_path)).collect()), key=repr) for f in (derived.trades, derived.dim_customer)]
    want = got()
    spark.conf.set("brokerdw.lookupRows", "19")
    try:
        assert got() == want and len(want[0]) >= 90 and len(want[1]) >= 20
        names = plan(derived.dim_customer(spark, str(tmp_path)))
    finally:
        spark.conf.unset("brokerdw.lookupRows")
    assert "BroadcastHashJoin [l_orderkey" in bases[0] and "SortMergeJoin [l_orderkey" in bases[1]
    assert "SortMergeJoin [_l0" in names and "BroadcastHashJoin [_l0" not in names
