"""Grouped selections that combine map-side, so no group is ever collected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_record(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], cols: Sequence[str] | None = None
) -> DataFrame:
    """The last row of each key; ``order_by`` should be a total order per key."""
    cols = [c for c in df.columns if c not in keys] if cols is None else list(cols)
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*cols), F.struct(*order_by)).alias("_last"))
        .select(*keys, *[F.col(f"_last.{c}").alias(c) for c in cols])
    )


def top1(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], descending: bool = True) -> DataFrame:
    """The first row of each key in the given order, without sorting the group."""
    pick = F.max_by if descending else F.min_by
    cols = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(pick(F.struct(*cols), F.struct(*order_by)).alias("_top"))
        .select(*keys, *[F.col(f"_top.{c}").alias(c) for c in cols])
    )


def placed_removed(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    action: str,
    cancel_value: str = "CNCL",
    ignore_cancel: bool = True,
    extra: Sequence = (),
) -> DataFrame:
    """First placement and last cancellation per key.

    ``ignore_cancel`` takes the placement from rows that are not cancellations;
    otherwise from all rows.
    """
    is_cancel = F.col(action) == F.lit(cancel_value)
    placed = F.min(F.when(~is_cancel, F.col(ts))) if ignore_cancel else F.min(ts)
    return df.groupBy(*keys).agg(
        placed.alias("placed"), F.max(F.when(is_cancel, F.col(ts))).alias("removed"), *extra
    )


def first_last_seen(
    df: DataFrame, batch: str = "batchid", cols: Sequence[str] | None = None, last: str = "recordbatchid"
) -> DataFrame:
    """Collapse full snapshots to distinct records with the first and last batch showing them."""
    cols = [c for c in df.columns if c != batch] if cols is None else list(cols)
    return df.groupBy(*cols).agg(F.max(batch).alias(last), F.min(batch).alias(batch))


def snapshot_as_of(df: DataFrame, n: int, batch: str = "batchid", last: str = "recordbatchid") -> DataFrame:
    """Records of :func:`first_last_seen` visible at batch ``n``."""
    seen = df.filter((F.col(batch) <= n) & (F.col(last) >= n))
    return seen.withColumn(last, F.least(F.col(last), F.lit(n)))


def latest_snapshot_row(df: DataFrame, keys: Sequence[str], batch: str = "batchid") -> DataFrame:
    """Newest row of each key over all snapshots, with the last and the first batch of the key."""
    cols = [c for c in df.columns if c not in keys and c != batch]
    newest = df.groupBy(*keys).agg(
        F.max_by(F.struct(F.lit(1).alias("_"), *cols), F.col(batch)).alias("_row"),
        F.max(batch).cast("int").alias("recordbatchid"),
        F.min(batch).alias(batch),
    )
    return newest.select(*keys, *[F.col("_row")[c].alias(c) for c in cols], "recordbatchid", batch)
