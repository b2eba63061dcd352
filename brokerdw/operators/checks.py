"""Data-quality operators on single tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brokerdw.operators.hotkeys import HotKeys, bounded_window, running, stored
from brokerdw.operators.sketch import may_hold, words_for
from brokerdw.operators.temporal import END, START


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or are null, with their row count."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter((F.col("rows") > 1) | missing)


def check_fk(child: DataFrame, parent: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """Child rows whose non-null reference has no parent row.

    The child's distinct keys, combined before the shuffle, are joined to the parent; that
    leaves the keys without one. A Bloom sketch of those, sized by their number, then picks
    the child's rows where they lie, and the few that pass are joined exactly. So the child
    is read twice and not shuffled, whatever the size of the parent. With so many lost keys
    that a sketch would be too large, the rows are joined like any table.
    """
    cols = [c for c, _ in on]
    names = [f"_fk{i}" for i in range(len(cols))]
    there = child.dropna(subset=cols)
    keys = there.select(*[F.col(c).alias(n) for c, n in zip(cols, names, strict=True)]).distinct()
    known = parent.select(*[F.col(p).alias(n) for (_, p), n in zip(on, names, strict=True)])
    lost = stored(keys.join(known, names, "left_anti"), "lost-keys")
    words = words_for(lost.count())
    found = there if words is None else may_hold(there, cols, lost, words)
    same = F.lit(True)
    for c, n in zip(cols, names, strict=True):
        same = same & (F.col(c) == F.col(n))
    return found.join(lost, same, "left_semi")


def expect(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One pass over ``df``: per rule the rows that pass and that fail.

    Rows are only counted, never dropped; an unknown outcome fails.
    """
    flags = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    counts = df.agg(
        *[F.count_if(ok).alias(f"_ok{i}") for i, ok in enumerate(flags.values())],
        F.count(F.lit(1)).alias("_all"),
    )
    rows = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col(f"_ok{i}").alias("passed"),
            (F.col("_all") - F.col(f"_ok{i}")).alias("failed"),
        )
        for i, name in enumerate(flags)
    ]
    return counts.select(F.inline(F.array(*rows)))


def overlapping_versions(df: DataFrame, keys: Sequence[str], hot: HotKeys | None = None) -> DataFrame:
    """Versions that run past the start of their successor.

    Sorted by start, some pair of intervals overlaps exactly if some neighbours do,
    so no self join is needed.
    """
    nexts = bounded_window(
        df, keys, [START, END], {"_next": lambda w: F.lead(START).over(w)}, following=1, hot=hot
    )
    return nexts.filter(F.col("_next") < F.col(END)).drop("_next")


def overlap_counts(df: DataFrame, keys: Sequence[str], start: str = START, end: str = END, hot: HotKeys | None = None) -> DataFrame:
    """Per key, ``pairs``: how often an interval starts while another one of the key is open.

    Two intervals with one start count twice, as each starts within the other; an empty one
    can start within another but holds none. Starts and ends are signed events, added up by
    day before the shuffle; their running sum is the number of open intervals on each day,
    so pairs are counted without being formed.
    """
    holds = (F.col(start) < F.col(end)).cast("int")
    event = lambda day, opened, begun: F.struct(F.col(day).alias("_day"), opened.alias("_opened"), begun.alias("_begun"))
    events = F.array(event(start, holds, F.lit(1)), event(end, -holds, F.lit(0)))
    rows = df.filter(F.col(start).isNotNull() & F.col(end).isNotNull()).withColumn("_own", holds)
    days = rows.select(*keys, "_own", F.inline(events)).groupBy(*keys, "_day").agg(
        F.sum("_opened").alias("_opened"), F.sum("_begun").alias("_begun"), F.sum(F.col("_own") * F.col("_begun")).alias("_own")
    )
    known = running(days, keys, ["_day"], "_opened", "_before", "sum", hot)
    there = F.coalesce("_before", F.lit(0)) + F.col("_opened")
    return known.groupBy(*keys).agg(F.sum(F.col("_begun") * there - F.col("_own")).alias("pairs"))
