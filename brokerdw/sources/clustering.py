"""Layout of a table by several columns at once, so that files can be skipped by any of them.

Sorting by two columns lets a reader skip files by the first one only. Here each column's
value is replaced by its rank among quantiles, and the bits of the ranks are interleaved to
one number (a Z-order): rows that are near in every column are near in it, so each file
covers a small range of every column, which Parquet's statistics show to the reader.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brokerdw.operators.hotkeys import ordinal, stored

BITS = 8  # a column's rank is one of 2 ** BITS


def rank_edges(df: DataFrame, columns: Sequence[str]) -> list[list[int]]:
    """Quantiles of each column, ``2 ** BITS - 1`` numbers a column at most, from one pass."""
    shares = [i / (1 << BITS) for i in range(1, 1 << BITS)]
    found = df.agg(*[F.percentile_approx(ordinal(df, c), shares, 10_000).alias(f"_q{i}") for i, c in enumerate(columns)]).first()
    return [sorted(q or []) for q in found]


def rank(value: Column, edges: Sequence[int]) -> Column:
    """How many edges lie at or below the value, found by halving; 0 for a null."""
    if not edges:
        return F.lit(0)
    known = F.array(*[F.lit(int(e)).cast("long") for e in edges])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(edges).bit_length()))])

    def step(at: Column, width: Column) -> Column:
        return F.when(F.coalesce(F.get(known, at + width - 1) <= value, F.lit(False)), at + width).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def interleaved(ranks: Sequence[Column]) -> Column:
    """One number whose bits are taken from the ranks in turn, highest first."""
    out = F.lit(0).cast("long")
    for b in range(BITS):
        for i, r in enumerate(reversed(ranks)):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(r, b).bitwiseAND(F.lit(1)).cast("long"), b * len(ranks) + i))
    return out


def cluster(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` dealt and sorted so that each file covers a small range of every one of ``columns``.

    One column is range-partitioned as it is. The columns are numbers, dates or timestamps.
    """
    if len(columns) == 1:
        return df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    df = stored(df, "to-cluster")  # read for the quantiles, the ranges and the write
    ranks = [rank(ordinal(df, c), e) for c, e in zip(columns, rank_edges(df, columns), strict=True)]
    placed = df.withColumn("_z", interleaved(ranks))
    return placed.repartitionByRange("_z").sortWithinPartitions("_z", *columns).drop("_z")
