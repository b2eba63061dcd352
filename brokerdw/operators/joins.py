"""Matching joins: normalised text keys, and two change sources combined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brokerdw.functions.exprs import match_key


def name_match_join(
    left: DataFrame,
    right: DataFrame,
    cols: Sequence[str],
    nullable_cols: Sequence[str] = (),
    how: str = "left",
    right_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Case-insensitive equality on ``cols``; in ``nullable_cols`` null equals blank.

    The normalised forms are computed once per row on each side, so the match is a
    plain equality join.
    """
    all_cols = [*cols, *nullable_cols]
    keep = list(right_cols) if right_cols is not None else [c for c in right.columns if c not in left.columns]

    def keyed(df: DataFrame, prefix: str) -> DataFrame:
        return df.withColumns(
            {f"{prefix}{i}": match_key(c, c in nullable_cols) for i, c in enumerate(all_cols)}
        )

    lhs = keyed(left, "_l")
    rhs = keyed(right, "_r").select(
        *[f"_r{i}" for i in range(len(all_cols))], *[F.col(c).alias(f"_m_{c}") for c in keep]
    )
    cond = F.lit(True)
    for i in range(len(all_cols)):
        cond = cond & (F.col(f"_l{i}") == F.col(f"_r{i}"))
    joined = lhs.join(rhs, cond, how)
    if how in ("left_semi", "left_anti"):
        return joined.select(*left.columns)
    return joined.select(*left.columns, *[F.col(f"_m_{c}").alias(c) for c in keep])


def coalesce_outer(left: DataFrame, right: DataFrame, on: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Full outer join of two change sources; the left value wins where it is not null."""
    rhs = right.select(*[F.col(c).alias(f"_o_{c}") for c in [*on, *cols]])
    cond = F.lit(True)
    for c in on:
        cond = cond & (F.col(c) == F.col(f"_o_{c}"))
    joined = left.select(*on, *cols).join(rhs, cond, "full_outer")
    return joined.select(*[F.coalesce(F.col(c), F.col(f"_o_{c}")).alias(c) for c in [*on, *cols]])
