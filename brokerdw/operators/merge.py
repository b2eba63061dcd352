"""Keyed merges expressed as DataFrame plans (file tables have no MERGE)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brokerdw.functions.exprs import open_end, smart_key
from brokerdw.operators.temporal import CURRENT, END, START

DUPLICATE = "merge: several source rows match one target row"


def _null_key(on: Sequence[str], prefix: str = "") -> Column:
    test = F.lit(False)
    for c in on:
        test = test | F.col(prefix + c).isNull()
    return test


def _numbered(source: DataFrame, on: Sequence[str]) -> DataFrame:
    """Source rows with a non-null key and how many share it."""
    w = Window.partitionBy(*on)
    return source.filter(~_null_key(on)).withColumn("_dup", F.count(F.lit(1)).over(w))


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    matched: Sequence[tuple[Column | None, dict[str, Column]]] = (),
    insert: bool | dict[str, Column] = True,
    insert_when: Column | None = None,
    eligible: Column | None = None,
) -> DataFrame:
    """MERGE INTO as a full outer join.

    In conditions and values the target columns are ``t_<name>`` and the source
    columns ``s_<name>``. The first clause of ``matched`` whose condition holds (a
    ``None`` condition always does) sets the given target columns. Source rows
    without a partner are inserted (by name, or from the given expressions) if
    ``insert_when`` holds; rows with a null key never match. ``eligible`` limits the
    target rows that can match. Two source rows matching one target row raise an
    error, as MERGE does.
    """
    t_cols = target.columns
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in t_cols]).withColumn("_t", F.lit(True))
    s = _numbered(source, on)
    s = s.select(*[F.col(c).alias(f"s_{c}") for c in source.columns], "_dup").withColumn("_s", F.lit(True))
    cond = F.lit(True) if eligible is None else eligible
    for c in on:
        cond = cond & (F.col(f"t_{c}") == F.col(f"s_{c}"))
    joined = t.join(s, cond, "full_outer" if insert else "left")
    both = F.col("_t").isNotNull() & F.col("_s").isNotNull()
    checked = joined.filter(
        F.when(both & (F.col("_dup") > 1), F.raise_error(F.lit(DUPLICATE)).cast("boolean")).otherwise(True)
    )

    inserts: dict[str, Column] = {}
    if insert is True:
        inserts = {c: F.col(f"s_{c}") for c in t_cols if c in source.columns}
    elif insert:
        inserts = dict(insert)

    def inserted(c: str) -> Column:
        return inserts.get(c, F.lit(None)).cast(target.schema[c].dataType)

    def value(c: str) -> Column:
        out = F.when(F.col("_t").isNull(), inserted(c))
        earlier = F.lit(False)
        for condition, sets in matched:
            fires = both & ~earlier & (F.lit(True) if condition is None else F.coalesce(condition, F.lit(False)))
            if c in sets:
                out = out.when(fires, sets[c].cast(target.schema[c].dataType))
            if condition is None:
                break
            earlier = earlier | F.coalesce(condition, F.lit(False))
        return out.otherwise(F.col(f"t_{c}")).alias(c)

    if insert and insert_when is not None:
        checked = checked.filter(F.col("_t").isNotNull() | F.coalesce(insert_when, F.lit(False)))
    out = checked.select(*[value(c) for c in t_cols])
    if insert:
        loose = source.filter(_null_key(on)).select(*[F.col(c).alias(f"s_{c}") for c in source.columns])
        if insert_when is not None:
            loose = loose.filter(insert_when)
        out = out.unionByName(loose.select(*[inserted(c).alias(c) for c in t_cols]))
    return out


@dataclass(frozen=True)
class Scd2Merge:
    """Outcome of a type 2 merge without the history closed before.

    ``rows`` holds the versions that end in this batch (``iscurrent`` false, to be
    added to the history) and all versions current afterwards (to replace the current
    rows), computed in one pass so that a store writes both at once.
    """

    rows: DataFrame

    @property
    def closed(self) -> DataFrame:
        return self.rows.filter(~F.col(CURRENT))

    @property
    def current(self) -> DataFrame:
        return self.rows.filter(F.col(CURRENT))

    def with_history(self, history: DataFrame) -> DataFrame:
        """The whole table, given the versions that were closed before."""
        return history.unionByName(self.rows)


def scd2_merge(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    coalesce_cols: Sequence[str] = (),
    surrogate: tuple[str, str] | None = None,
    inplace: DataFrame | None = None,
    inplace_cols: Sequence[str] = (),
) -> Scd2Merge:
    """Close the current version of each changed key and open a new one.

    ``changes`` has one row per key with the target's columns (``effectivedate`` is
    the day of change; interval columns are set here). Nulls in ``coalesce_cols``
    keep the previous version's value. ``surrogate = (column, key)`` recomputes the
    smart key. ``inplace`` holds updates that overwrite ``inplace_cols`` of a current
    version without opening a new one; a key that also changes is skipped there.

    Only current rows of ``target`` are read: cost follows the current rows and the
    changes, not the history.
    """
    cols = target.columns
    t = target.filter(F.col(CURRENT)).select(*[F.col(c).alias(f"t_{c}") for c in cols]).withColumn("_t", F.lit(True))
    given = [c for c in cols if c in changes.columns and c not in (END, CURRENT)]

    def one_row(df: DataFrame, prefix: str, wanted: Sequence[str], mark: str) -> DataFrame:
        rows = _numbered(df, keys).filter(
            F.when(F.col("_dup") > 1, F.raise_error(F.lit(DUPLICATE)).cast("boolean")).otherwise(True)
        )
        return rows.select(*[F.col(c).alias(f"{prefix}{c}") for c in wanted]).withColumn(mark, F.lit(True))

    def same_key(left: str, right: str) -> Column:
        cond = F.col(f"{left}{keys[0]}") == F.col(f"{right}{keys[0]}")
        for c in keys[1:]:
            cond = cond & (F.col(f"{left}{c}") == F.col(f"{right}{c}"))
        return cond

    if inplace is not None:
        p = one_row(inplace, "p_", [*keys, *inplace_cols], "_p")
        t = t.join(p, same_key("t_", "p_"), "left")
    joined = t.join(one_row(changes, "s_", given, "_s"), same_key("t_", "s_"), "full_outer")
    changed = F.col("_s").isNotNull()

    def opened(c: str) -> Column:
        if c == END:
            out = open_end()
        elif c == CURRENT:
            out = F.lit(True)
        elif surrogate and c == surrogate[0]:
            out = smart_key(F.col(f"s_{START}"), F.col(f"s_{surrogate[1]}"))
        elif c not in given:
            out = F.lit(None)
        elif c in coalesce_cols:
            out = F.coalesce(F.col(f"s_{c}"), F.col(f"t_{c}"))
        else:
            out = F.col(f"s_{c}")
        return out.cast(target.schema[c].dataType)

    def kept(c: str) -> Column:
        if inplace is not None and c in inplace_cols:
            value = F.col(f"p_{c}").cast(target.schema[c].dataType)
            return F.when(F.col("_p").isNotNull(), value).otherwise(F.col(f"t_{c}"))
        return F.col(f"t_{c}")

    def ended(c: str) -> Column:
        return {END: F.col(f"s_{START}"), CURRENT: F.lit(False)}.get(c, F.col(f"t_{c}"))

    current = F.struct(*[F.when(changed, opened(c)).otherwise(kept(c)).alias(c) for c in cols])
    closed = F.struct(*[ended(c).alias(c) for c in cols])
    versions = F.when(changed & F.col("_t").isNotNull(), F.array(closed, current)).otherwise(F.array(current))
    return Scd2Merge(joined.select(F.inline(versions)))


def propagate_versions(
    child: DataFrame, closed_parent: DataFrame, new_parent: DataFrame, key: str, parent_sk: str
) -> DataFrame:
    """New child versions forced by a new parent version.

    Each current child of a parent version that was closed (``closed_parent``) gets a
    change row pointing to the version that replaced it (``new_parent``), starting
    the same day.
    """
    replaced = closed_parent.select(F.col(parent_sk).alias("_old"), F.col(key).alias("_key"), F.col(END).alias("_at"))
    replacing = new_parent.select(F.col(parent_sk).alias("_new"), F.col(key).alias("_nkey"), F.col(START).alias("_from"))
    link = replaced.join(
        replacing, (F.col("_key") == F.col("_nkey")) & (F.col("_at") == F.col("_from")), "inner"
    ).select("_old", "_new", "_from")
    current = child.filter(F.col(CURRENT)).drop(START)
    joined = current.join(link, current[parent_sk] == F.col("_old"), "inner")
    return joined.drop(parent_sk, "_old").withColumnsRenamed({"_new": parent_sk, "_from": START}).select(*child.columns)
