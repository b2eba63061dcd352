"""Batches loaded from what the batch before left equal one run over all of them, in order or late."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from brokerdw.plans import carried, stages

DAY = date(2015, 1, 1)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def made(spark, late, seed):
    """Transactions and quotes of three batches for a few keys and null; ``late`` is the share dated before their batch."""
    rng = random.Random(seed)
    cash, quotes, seen = [], [], set()
    for batch in (1, 2, 3):
        for _ in range(160):
            days = 100 * batch + rng.randrange(100)
            days = rng.randrange(100 * batch) if rng.random() < late else days
            day = DAY + timedelta(days)
            key = rng.choice([1, 2, 3, None]) if batch > 1 else rng.choice([1, 2])
            cash.append((key, None if late and rng.random() < 0.05 else day, rng.choice([0.1, -2.25, 3.0001, None]), batch))
            if (key, day, batch) not in seen:
                seen.add((key, day, batch))
                quotes.append((day, None if key is None else f"S{key}", rng.randrange(50) / 4, rng.choice([None, 20.0, 21.0, 22.5]), rng.randrange(9) / 4, 7, batch))
    cash = spark.createDataFrame(cash, "accountid long, ct_dts date, ct_amt double, batchid int")
    quotes = spark.createDataFrame(quotes, "dm_date date, dm_s_symb string, dm_close double, dm_high double, dm_low double, dm_vol int, batchid int")
    return cash.persist(), quotes.persist()


@pytest.mark.parametrize("late", [0.0, 0.2])
def test_balances(spark, late):
    cash, _ = made(spark, late, 1)
    days = carried.cash_days(cash).persist()
    closing = carried.close_balances(days.filter("batchid = 1"))
    for n in (2, 3):
        mine = days.filter(F.col("batchid") == n)
        got = carried.cash_after(mine, closing, days.filter(F.col("batchid") < n))
        want = stages.cash_stage(cash.filter(F.col("batchid") <= n)).filter(F.col("batchid") == n)
        assert rows(got.select(*want.columns)) == rows(want) and got.count() > 90
        closing = carried.close_balances(mine, closing).persist()
    assert closing.count() == 4


@pytest.mark.parametrize("late", [0.0, 0.2])
@pytest.mark.parametrize("preceding", [5, 30, 364])
def test_extremes(spark, late, preceding):
    _, quotes = made(spark, late, 2)
    tails = carried.quote_tails(quotes.filter("batchid = 1"), rows=preceding)
    for n in (2, 3):
        mine = quotes.filter(F.col("batchid") == n)
        got = carried.market_after(mine, tails, quotes.filter(F.col("batchid") < n), preceding)
        want = stages.daily_market_stage(quotes.filter(F.col("batchid") <= n), preceding).filter(F.col("batchid") == n)
        assert rows(got.select(*want.columns)) == rows(want) and got.count() > 90
        tails = carried.quote_tails(mine, tails, preceding).persist()
        assert tails.groupBy("dm_s_symb").count().agg(F.max("count")).first()[0] <= preceding


def test_snapshots(spark):
    snapshots = [(1, "a", None, 1), (1, "a", None, 1), (2, "b", 5, 1), (1, "a", None, 2), (3, None, None, 2), (2, "b", 5, 3), (3, None, None, 3)]
    df = spark.createDataFrame(snapshots, "k int, s string, v int, batchid int")
    from brokerdw.operators.grouping import first_last_seen

    state = first_last_seen(df.filter("batchid = 1")).withColumn("tag", F.lit("x"))
    for n in (2, 3):
        state = carried.seen_after(state, df.filter(F.col("batchid") == n), ["tag"])
        want = first_last_seen(df.filter(F.col("batchid") <= n))
        assert rows(state.select(*want.columns)) == rows(want)


def test_in_order_batches_read_no_earlier_days(spark):
    """Without late rows the days and quotes of earlier batches are not touched: reading them would fail."""
    cash, quotes = made(spark, 0.0, 3)
    trap = F.when(F.raise_error(F.lit("earlier rows were read")).isNull(), F.lit(1)).cast("int")
    first, second = cash.filter("batchid = 1"), quotes.filter("batchid = 1")
    days = carried.cash_days(cash.filter("batchid = 2"))
    broken = carried.cash_days(first).withColumn("batchid", trap)
    assert carried.cash_after(days, carried.close_balances(carried.cash_days(first)), broken).count() > 0
    got = carried.market_after(quotes.filter("batchid = 2"), carried.quote_tails(second), second.withColumn("batchid", trap))
    assert got.count() > 0
