"""Ordered aggregates: running balances, 52-week extremes, trailing sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brokerdw.operators.hotkeys import BLOCK, HALO, HotKeys, bounded_window, hot_window_keys, ordinal, spread_blocks


def running_balance(
    df: DataFrame, key: str, date: str, amount: str, extra_keys: Sequence[str] = (), out: str = "cash"
) -> DataFrame:
    """Daily totals per key, then the balance up to and including each day.

    Amounts are rounded to four decimals and summed as decimals of up to 24 digits before
    the point, so the result does not depend on row order. The
    window runs over daily totals: a key has at most one row per day (and value of
    ``extra_keys``) left, however many rows it had before. Rows of one day share the
    day's balance.
    """
    daily = (
        df.withColumn("_day", F.to_date(date))
        .groupBy(key, "_day", *extra_keys)
        .agg(F.sum(F.col(amount).cast("decimal(28,4)")).alias("_total"))
    )
    upto = Window.partitionBy(key).orderBy("_day").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    balance = F.sum("_total").over(upto).cast("double")
    return daily.select(key, F.col("_day").alias("datevalue"), balance.alias(out), *extra_keys)


# Frames of more rows than this are put together from block prefixes and suffixes.
WIDE_FRAME = 16


def rolling_extremes(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    low: str,
    high: str,
    preceding: int = 364,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Lowest ``low`` and highest ``high`` of the last ``preceding`` + 1 rows, with dates.

    Adds ``low_value, low_date, high_value, high_date``; of equal values the earliest
    date counts. The date is the first of ``order_by``.
    """
    date = order_by[0]
    lowest = F.when(F.col(low).isNotNull(), F.struct(F.col(low).alias("v"), F.col(date).alias("d")))
    highest = F.when(
        F.col(high).isNotNull(),
        F.struct(F.col(high).alias("v"), (-ordinal(df, date)).alias("o"), F.col(date).alias("d")),
    )
    packed = df.withColumns({"_low": lowest, "_high": highest})
    hot = hot_window_keys(df, [key]) if hot is None else hot
    keys = [key]
    if hot:
        packed = spread_blocks(packed, keys, order_by, preceding, 0, hot)
        keys = [key, BLOCK]
    found = _frame_extremes(packed, keys, order_by, preceding)
    if hot:
        found = found.filter(~F.col(HALO))
    return found.select(
        *df.columns,
        F.col("_low.v").alias("low_value"),
        F.col("_low.d").alias("low_date"),
        F.col("_high.v").alias("high_value"),
        F.col("_high.d").alias("high_date"),
    )


def _frame_extremes(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], preceding: int) -> DataFrame:
    """Minimum of ``_low`` and maximum of ``_high`` over the last ``preceding`` + 1 rows.

    A sliding frame costs its width per row. Cut into blocks as wide as the frame,
    each frame is the end of one block and the start of the next: the extreme of the
    block up to the row, and the extreme from the row where the frame starts to the
    end of its block. That is a constant number of steps per row, and all windows
    share one shuffle on the key.
    """
    by_key = Window.partitionBy(*keys).orderBy(*order_by)
    if preceding < WIDE_FRAME:
        frame = by_key.rowsBetween(-preceding, Window.currentRow)
        return df.withColumns({"_low": F.min("_low").over(frame), "_high": F.max("_high").over(frame)})
    width = preceding + 1
    placed = df.withColumn("_at", F.row_number().over(by_key) - 1).withColumn("_cut", F.floor(F.col("_at") / width))
    in_cut = Window.partitionBy(*keys, "_cut")
    from_row = in_cut.orderBy(F.col("_at").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    to_row = in_cut.orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = placed.withColumns({"_low_end": F.min("_low").over(from_row), "_high_end": F.max("_high").over(from_row)})
    starts = ends.withColumns({"_low_start": F.min("_low").over(to_row), "_high_start": F.max("_high").over(to_row)})
    by_place = Window.partitionBy(*keys).orderBy("_at")
    before = starts.withColumns(
        {
            "_low_end": F.lag("_low_end", preceding).over(by_place),
            "_high_end": F.lag("_high_end", preceding).over(by_place),
        }
    )
    whole = F.col("_at") % width == preceding  # the frame is exactly one block
    return before.withColumns(
        {
            "_low": F.when(whole, F.col("_low_start")).otherwise(F.least("_low_start", "_low_end")),
            "_high": F.when(whole, F.col("_high_start")).otherwise(F.greatest("_high_start", "_high_end")),
        }
    )


def trailing_sum(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    value: str,
    start: int = -4,
    end: int = -1,
    out: str = "trailing_sum",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Sum of ``value`` over rows ``start``..``end`` relative to the row; null if there are none."""
    return bounded_window(
        df,
        [key],
        order_by,
        {out: lambda w: F.sum(F.col(value)).over(w.rowsBetween(start, end))},
        preceding=max(0, -start),
        following=max(0, end),
        hot=hot,
    )


def cumulative_by_group(df: DataFrame, group: str, value: str, out: str = "cumulative") -> DataFrame:
    """Total per group and its running sum over the groups.

    Meant for a bounded number of groups such as batch ids: the window runs over one
    row per group.
    """
    totals = df.groupBy(group).agg(F.sum(F.col(value).cast("decimal(28,4)")).alias("total"))
    w = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return totals.select(
        group, F.col("total").cast("double").alias("total"), F.sum("total").over(w).cast("double").alias(out)
    )
