"""Expressions: golden cases, blanks and malformed values under ANSI."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from brokerdw.functions import exprs as X
from brokerdw.sources.scans import classify_finwire, parse_cmp, parse_fin, try_parse


def one(spark, row, schema, col):
    return spark.createDataFrame([row], schema).select(col.alias("x")).first().x


@pytest.mark.parametrize(
    "parts, want",
    [
        (("1", "212", "555-1234", "99"), "+1 (212) 555-123499"),
        ((None, None, "555-1234", None), "555-1234"),
        (("1", "212", "", None), None),
        (("", "", "555", ""), "555"),
    ],
)
def test_phone(spark, parts, want):
    assert one(spark, parts, "a string, b string, c string, d string", X.format_phone("a", "b", "c", "d")) == want


@pytest.mark.parametrize(
    "row, want",
    [
        ((2000000, "10000", 0, 0, 20, 0, 700), "HighValue+MoneyAlert+Inherited"),
        ((500000, "100000", 0, 0, 30, 0, 700), ""),
        ((None, None, None, None, None, None, None), ""),
        ((500000, "x", 4, 8, 50, 4, 700), "Expenses+Boomer+Spender"),
    ],
)
def test_nameplate(spark, row, want):
    schema = "w int, i string, ch int, cards int, age int, cars int, credit int"
    assert one(spark, row, schema, X.nameplate("w", "i", "ch", "cards", "age", "cars", "credit")) == want


def test_company_ref(spark):
    got = [one(spark, (v,), "v string", X.norm_company_ref("v")) for v in ("0000000123", "ACME ", "12x")]
    assert got == ["123", "ACME", "12x"]


def test_rating_gender_decode(spark):
    got = spark.createDataFrame([("AAA", "m", "CMPT"), ("BB+", "x", "??"), ("ZZ", None, None)], "r string, g string, s string")
    rows = got.select(X.rating("r"), X.is_low_grade("r"), X.norm_gender("g"), X.decode_status("s")).collect()
    assert [tuple(r) for r in rows] == [("AAA", False, "M", "Completed"), ("BB+", True, "U", None), (None, None, "U", None)]


@pytest.mark.parametrize("kind, good", [("bigint", "12"), ("double", "1.5"), ("date", "20200131")])
def test_blank_and_malformed_values_become_null(spark, kind, good):
    rows = spark.createDataFrame([(" ",), ("zz",), (good,), (None,)], "v string").select(try_parse("v", kind).alias("x"))
    values = [r.x for r in rows.collect()]
    assert values[0] is None and values[1] is None and values[2] is not None and values[3] is None


def test_full_years(spark):
    row = (date(1917, 7, 8), date(2017, 7, 7))
    assert one(spark, row, "a date, b date", X.full_years("a", "b")) == 99
    assert one(spark, (date(1917, 7, 7), date(2017, 7, 7)), "a date, b date", X.full_years("a", "b")) == 100


def test_wire_records(spark):
    from tests.raw_extract import _cmp, _fin

    lines = [_cmp("20070101", "ACME", 1, "BB+"), _fin("20100201", 2010, 2, 1.5, "0000000001"), _fin("20100201", 2010, 3, 2.0, "ACME")]
    stage = classify_finwire(spark.createDataFrame([(v,) for v in lines], "value string"))
    assert sorted(r.rectype for r in stage.collect()) == ["CMP", "FIN_COMPANYID", "FIN_NAME"]
    cmp = parse_cmp(stage).first()
    assert (cmp.companyname, cmp.cik, cmp.sprating, cmp.recdate, cmp.addressline2) == ("ACME", "0000000001", "BB+", date(2007, 1, 1), "")
    fin = {r.fi_qtr: r for r in parse_fin(stage).collect()}
    assert fin[2].fi_basic_eps == 1.5 and fin[2].fi_inventory is None and fin[3].conameorcik == "ACME"


def test_stable_key(spark):
    got = spark.createDataFrame([("A", date(2020, 1, 1))] * 2, "s string, d date").select(X.stable_key("s", "d").alias("k"))
    keys = {r.k for r in got.collect()}
    assert len(keys) == 1 and 0 <= keys.pop() < 2**60


def test_date_time_keys(spark):
    df = spark.sql("SELECT TIMESTAMP '2020-01-03 09:05:07' AS t").select(X.date_key("t"), X.time_key("t"), X.smart_key("t", F.lit(7)))
    assert tuple(df.first()) == (20200103, 90507, 202001037)


def test_keys_of_days_and_times_are_calculated(spark):
    df = spark.sql("SELECT explode(array(TIMESTAMP '2020-01-03 09:05:07', TIMESTAMP '0099-12-31 23:59:59', TIMESTAMP '9999-12-31 00:00:00', null)) AS t")
    day, time = F.date_format("t", "yyyyMMdd"), F.date_format("t", "HHmmss")
    wanted = df.select(day.cast("bigint"), time.cast("bigint"), F.concat(day, F.lit("7")).cast("bigint"))
    found = df.select(X.date_key("t"), X.time_key("t"), X.smart_key("t", F.lit(7)))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, wanted.collect()), key=repr)
    assert "date_format" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_texts_that_are_no_number_or_day_are_not_cast(spark):
    values = ["0012", "Supplier 1", "", None, "+5", "-7", " 8", "1.5", "é", "20200131", "20200230", "2000101\t", "+2000102", "2020-01-02", "zz"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    text = F.trim("v")
    old = F.coalesce(*[F.to_date(F.try_to_timestamp(text, F.lit(f))) for f in ("yyyyMMdd", "yyyy-MM-dd")])
    rows = df.select(X.try_long(text).alias("n"), text.try_cast("bigint").alias("m"), try_parse("v", "date").alias("d"), old.alias("e")).collect()
    assert [(r["n"], r["d"]) for r in rows] == [(r["m"], r["e"]) for r in rows]
    plan = df.select(X.norm_company_ref("v"))._jdf.queryExecution().optimizedPlan().toString()
    assert "ascii" in plan
