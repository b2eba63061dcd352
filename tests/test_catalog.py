"""Every registered query runs on the smallest tables and equals its SQL counterpart."""

import os

import duckdb
import pytest

from brokerdw.catalog import ORACLES, QUERIES
from check_oracles import TABLES, normal

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Slow ones are compared by check_oracles.py at a larger scale.
FAST = [n for n in QUERIES if n in ORACLES and not n.startswith(("dim_", "fact_", "cdc_", "alerts", "prospect", "visib", "audit"))]


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def compare(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(ORACLES[name])
    assert got == normal([c[0] for c in result.description], result.fetchall())


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, con, name):
    compare(spark, con, name)


@pytest.mark.parametrize("name", ["dim_trade", "fact_market_history", "fact_watches_batch"])
def test_product_equals_sql(spark, con, name):
    compare(spark, con, name)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) > 110


def test_audit_expects_all_data_sets_attributes_and_days_of_every_batch(spark):
    from brokerdw.catalog import derived
    from brokerdw.plans.audit import AUDIT_SOURCES

    w = derived.warehouse(spark, "/root/testdata/sf0.001")
    dates = {r["batchid"]: r["batchdate"] for r in derived.batch_date(spark).collect()}
    rows = derived.expected(w, dates).collect()
    assert {r["dataset"] for r in rows} == set(AUDIT_SOURCES)
    assert {(r["dataset"], r["attribute"], r["batchid"]) for r in rows} == {(r["dataset"], r["attribute"], b) for r in rows for b in dates}
    days = {(r["attribute"], r["batchid"]): str(r["date"]) for r in rows if r["dataset"] == "Batch"}
    assert days["FirstDay", 1] == "1950-01-01" and days["LastDay", 1] == "2001-12-31" and days["FirstDay", 3] == days["LastDay", 3] == "2002-01-02"
    value = {(r["attribute"], r["batchid"]): r["value"] for r in rows}
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    late = orders.filter("o_orderdate >= '2000-06-01'")
    assert value["C_NEW", 1] == spark.read.parquet("/root/testdata/sf0.001/customer.parquet").count() and value["C_NEW", 2] == 0
    assert value["WH_RECORDS", 1] + value["WH_RECORDS", 2] == orders.count() and value["WH_RECORDS", 2] == late.count()
    assert sum(value[k, b] for k in ("C_UPDCUST", "C_INACT") for b in (2, 3)) == late.select("o_custkey").distinct().count()
    assert value["FW_FIN", 1] > 0 and value["T_NEW", 1] > value["T_NEW", 2] == 0
