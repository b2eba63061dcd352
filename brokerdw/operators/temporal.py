"""Slowly changing dimensions and joins on validity intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brokerdw.functions.exprs import OPEN_END, open_end
from brokerdw.operators.hotkeys import (
    HOT_VERSIONS,
    HotKeys,
    bounded_window,
    carry_last,
    find_hot_keys,
    hot_window_keys,
    looked_up,
    row_count,
    running,
    split_hot,
    stored,
)

START, END, CURRENT = "effectivedate", "enddate", "iscurrent"


def _names(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _many_versions(versions: DataFrame, keys: Sequence[str]) -> HotKeys:
    """Keys with more validity intervals than one row should be compared with; a null key joins nothing.

    The limit can be set per session with ``brokerdw.hotVersions``.
    """
    limit = versions.sparkSession.conf.get("brokerdw.hotVersions", None)
    return many_versions(versions, keys, int(limit or HOT_VERSIONS))


def _sorted_if_long(right: DataFrame, versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``right`` of a join whose ``versions`` have been counted by :func:`_many_versions`."""
    return looked_up(right, row_count(versions.dropna(subset=list(keys)), keys))


def many_versions(versions: DataFrame, keys: Sequence[str], limit: int) -> HotKeys:
    return find_hot_keys(versions.dropna(subset=list(keys)), keys, limit)


def forward_fill(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: str | Sequence[str],
    cols: Sequence[str],
    hot: HotKeys | None = None,
) -> DataFrame:
    """Last known value of each column; ``order_by`` should be a total order per key."""
    return carry_last(df, _names(keys), _names(order_by), cols, hot)


def scd2_history(
    df: DataFrame,
    keys: str | Sequence[str],
    ts: str,
    tie: str | Sequence[str] = (),
    open_end_date: str = OPEN_END,
    drop_empty: bool = True,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Turn change records into validity intervals ``[effectivedate, enddate)``.

    The interval of a record ends on the day of the next record of its key. Several
    records on one day leave empty intervals for all but the last; they are dropped
    unless ``drop_empty`` is false.
    """
    order_by = [ts, *_names(tie)] if tie else [ts]
    dated = bounded_window(
        df,
        _names(keys),
        order_by,
        {"_next": lambda w: F.lead(F.col(ts)).over(w)},
        following=1,
        hot=hot,
    )
    out = (
        dated.withColumn(START, F.to_date(ts))
        .withColumn(END, F.coalesce(F.to_date("_next"), F.lit(open_end_date).cast("date")))
        .withColumn(CURRENT, F.col("_next").isNull())
        .drop("_next")
    )
    return out.filter(F.col(START) < F.col(END)) if drop_empty else out


def close_open_versions(
    df: DataFrame, keys: str | Sequence[str], tie: Sequence[str] = (), hot: HotKeys | None = None
) -> DataFrame:
    """``enddate`` / ``iscurrent`` from the next ``effectivedate`` of the key."""
    nexts = bounded_window(
        df, _names(keys), [START, *tie], {"_next": lambda w: F.lead(START).over(w)}, following=1, hot=hot
    )
    return (
        nexts.withColumn(END, F.coalesce("_next", open_end()))
        .withColumn(CURRENT, F.col(END) == open_end())
        .drop("_next")
    )


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


# Days are placed in blocks of powers of two; every date of the calendar lies within 2 ** LEVELS days of its first.
LEVELS, FIRST_DAY = 23, 1 << 22


def _blocks(start: Column, end: Column) -> Column:
    """The interval of days as few blocks (level, number): block b of level l holds the days from b * 2**l on."""
    block = "named_struct('l', l, 'b', {})"
    left, right = block.format("acc.s"), block.format("acc.e - 1")
    step = f"""(acc, l) -> named_struct(
        's', if(acc.s < acc.e, shiftright(acc.s + 1, 1), acc.s),
        'e', if(acc.s < acc.e, shiftright(acc.e, 1), acc.e),
        'out', concat(acc.out,
            if(acc.s < acc.e and acc.s % 2 = 1, array({left}), array()),
            if(acc.s < acc.e and acc.e % 2 = 1, array({right}), array())))"""
    return F.expr(f"""aggregate(sequence(0, {LEVELS}),
        named_struct('s', _s, 'e', _e, 'out', cast(array() as array<struct<l:int,b:int>>)), {step}, acc -> acc.out)""")


def _open_at(points: DataFrame, versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``points`` (keys, _day, _p) with ``_v``: each version (keys, _day, _end, _v) that is open on the day, or null.

    Points and versions of a key are stacked and sorted once, and the version that opened
    last is carried to the points behind it. That is the open one as long as the versions of
    a key follow each other. Versions that begin while an earlier one is open are set apart;
    they are cut into blocks of days and meet the points by equality of the block, so neither
    way compares a point with versions that are not open on its day.
    """
    known = versions.filter("_day < _end").dropna(subset=list(keys))
    reached = running(known, keys, ["_day", "_end"], "_end", "_reached", "max")
    reached = stored(reached, "open-versions")
    follows = F.col("_reached").isNull() | (F.col("_reached") <= F.col("_day"))
    chain, within = reached.filter(follows), reached.filter(~follows)
    opened = chain.select(*keys, "_day", F.lit(0).alias("_kind"), F.struct("_end", "_v").alias("_open"), F.lit(None).cast(points.schema["_p"].dataType).alias("_p"))
    asked = points.select(*keys, "_day", F.lit(1).alias("_kind"), F.lit(None).cast(opened.schema["_open"].dataType).alias("_open"), "_p")
    swept = carry_last(opened.unionByName(asked), keys, ["_day", "_kind"], ["_open"]).filter("_kind = 1")
    version = F.when(F.col("_open._end") > F.col("_day"), F.col("_open._v")).alias("_v")
    met = swept.select(*keys, "_day", "_p", version)
    if within.isEmpty():
        return met
    day = lambda c: F.unix_date(c) + FIRST_DAY
    cut = within.withColumns({"_s": day("_day"), "_e": day("_end")}).withColumn("_b", F.explode(_blocks(F.col("_s"), F.col("_e"))))
    cut = cut.select(*keys, F.col("_b.l").alias("_l"), F.col("_b.b").alias("_n"), "_v")
    level = F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("_l")
    placed = points.dropna(subset=[*keys, "_day"]).join(within.select(*keys).distinct(), list(keys), "left_semi")
    placed = placed.select(*keys, "_day", "_p", level).withColumn("_n", F.expr(f"shiftright(unix_date(_day) + {FIRST_DAY}, _l)"))
    more = placed.join(cut, [*keys, "_l", "_n"]).select(*keys, "_day", "_p", "_v")
    # A point that only a version within another one holds has no row without a version.
    marks = [F.xxhash64("_p").alias("_h0"), F.xxhash64(F.lit(1), "_p").alias("_h1")]
    found = more.select(*marks).distinct()
    alone = met.filter("_v is null").select("*", *marks).join(found, ["_h0", "_h1"], "left_anti").select(*met.columns)
    return met.filter("_v is not null").unionByName(alone).unionByName(more)


def _keyed(df: DataFrame, on: Sequence[str], **more: Column) -> DataFrame:
    return df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(on)], *[c.alias(n) for n, c in more.items()])


def pit_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[str, str]] | str,
    ts: str,
    how: str = "inner",
    dim_cols: Sequence[str] | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Join each fact row to the dimension version valid on its day.

    ``on`` is a column name or ``(fact column, dimension column)`` pairs, ``ts`` the
    date or timestamp of the fact, ``dim_cols`` the dimension columns to keep.

    Equality on the key lets Spark hash or sort-merge, with the interval as a
    residual test. A key with thousands of versions would compare every fact row
    with every version; facts and versions of such keys go through one ordered
    sweep instead.
    """
    pairs = [(on, on)] if isinstance(on, str) else list(on)
    keep = list(dim_cols) if dim_cols is not None else [c for c in dim.columns if c not in fact.columns]
    fact_keys, dim_keys = [f for f, _ in pairs], [d for _, d in pairs]
    right = dim.select(*dict.fromkeys([*dim_keys, START, END, *keep]))
    counted = hot is None
    if counted:
        hot = _many_versions(dim, dim_keys)
    swept = None
    if hot:
        fact, many = split_hot(fact, fact_keys, hot)
        right, their = split_hot(right, dim_keys, hot)
        points = _keyed(many, fact_keys, _day=F.to_date(ts), _p=F.struct(*many.columns))
        versions = _keyed(their, dim_keys, _day=F.col(START), _end=F.col(END), _v=F.struct(*keep, F.lit(True).alias("_is")))
        found = _open_at(points, versions, [f"_k{i}" for i in range(len(pairs))])
        found = found if how == "left" else found.filter("_v is not null")
        swept = found.select("_p.*", *[F.col(f"_v.{c}").alias(c) for c in keep])
    right = _prefixed(right, "_d_")
    right = _sorted_if_long(right, dim, dim_keys) if counted else right
    day = fact.withColumn("_day", F.to_date(ts))
    cond = (F.col("_day") >= F.col(f"_d_{START}")) & (F.col("_day") < F.col(f"_d_{END}"))
    for f, d in pairs:
        cond = (F.col(f) == F.col(f"_d_{d}")) & cond
    joined = day.join(right, cond, how).select(*fact.columns, *[F.col(f"_d_{c}").alias(c) for c in keep])
    return joined.unionByName(swept) if hot else joined


def current_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[str, str]] | str,
    how: str = "inner",
    dim_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Join to the current version of each dimension member."""
    pairs = [(on, on)] if isinstance(on, str) else list(on)
    keep = list(dim_cols) if dim_cols is not None else [c for c in dim.columns if c not in fact.columns]
    right = dim.filter(F.col(CURRENT)).select(
        *[F.col(d).alias(f"_d_{d}") for d in dict.fromkeys([*[d for _, d in pairs], *keep])]
    )
    right = looked_up(right, row_count(dim))
    cond = F.lit(True)
    for f, d in pairs:
        cond = cond & (F.col(f) == F.col(f"_d_{d}"))
    return fact.join(right, cond, how).select(*fact.columns, *[F.col(f"_d_{c}").alias(c) for c in keep])


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]] | str,
    how: str = "inner",
    right_cols: Sequence[str] | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Pair overlapping validity intervals of one key and clip them to the overlap.

    ``how`` is ``inner`` or ``left``; a left row without any overlap keeps its own
    interval. Empty intervals overlap nothing, and ``iscurrent`` follows the open end.

    Keys with many versions go through two ordered sweeps, see ``_overlaps``.
    """
    pairs = [(on, on)] if isinstance(on, str) else list(on)
    left_keys, right_keys = [a for a, _ in pairs], [b for _, b in pairs]
    taken = set(left.columns)
    keep = list(right_cols) if right_cols is not None else [
        c for c in right.columns if c not in taken and c not in (START, END, CURRENT)
    ]
    counted = hot is None
    if counted:
        both = left.select(*left_keys, START).union(right.select(*right_keys, START))
        hot = _many_versions(both, left_keys)
    lhs = left.filter(F.col(START) < F.col(END))
    rhs = right.select(*dict.fromkeys([*right_keys, START, END, *keep])).filter(F.col(START) < F.col(END))
    others = [c for c in left.columns if c not in (START, END, CURRENT)]
    pieces = None
    if hot:
        lhs, many = split_hot(lhs, left_keys, hot)
        rhs, their = split_hot(rhs, right_keys, hot)
        pieces = _overlaps(many, left_keys, their, right_keys, how).select(
            *[F.col(f"_a.{c}").alias(c) for c in others],
            *[F.col(f"_b.{c}").alias(c) for c in keep],
            F.greatest(F.col(f"_a.{START}"), F.col(f"_b.{START}")).alias(START),
            F.least(F.col(f"_a.{END}"), F.col(f"_b.{END}")).alias(END),
        )
    rhs = _prefixed(rhs, "_r_")
    rhs = _sorted_if_long(rhs, both, left_keys) if counted else rhs
    cond = (F.col(START) < F.col(f"_r_{END}")) & (F.col(END) > F.col(f"_r_{START}"))
    for a, b in pairs:
        cond = (F.col(a) == F.col(f"_r_{b}")) & cond
    joined = lhs.join(rhs, cond, how).select(
        *others,
        *[F.col(f"_r_{c}").alias(c) for c in keep],
        F.greatest(START, f"_r_{START}").alias(START),
        F.least(END, f"_r_{END}").alias(END),
    )
    out = joined.unionByName(pieces) if hot else joined
    return out.withColumn(CURRENT, F.col(END) == open_end())


def _overlaps(a: DataFrame, a_keys: Sequence[str], b: DataFrame, b_keys: Sequence[str], how: str) -> DataFrame:
    """Pairs ``_a, _b`` of overlapping intervals of a key; with ``left`` also each ``_a`` without one.

    Of two intervals that overlap, one is open when the other starts: each side's starts are
    looked up among the other side's intervals, equal starts from the left one only.
    """
    keys = [f"_k{i}" for i in range(len(a_keys))]
    points = lambda df, on: _keyed(df, on, _day=F.col(START), _p=F.struct(*df.columns))
    versions = lambda df, on: _keyed(df, on, _day=F.col(START), _end=F.col(END), _v=F.struct(*df.columns))
    ours = _open_at(points(a, a_keys), versions(b, b_keys), keys).select(F.col("_p").alias("_a"), F.col("_v").alias("_b"))
    theirs = _open_at(points(b, b_keys), versions(a, a_keys), keys).filter(F.col(f"_v.{START}") < F.col("_day"))
    theirs = theirs.select(F.col("_v").alias("_a"), F.col("_p").alias("_b"))
    both = ours.filter("_b is not null").unionByName(theirs)
    if how != "left":
        return both
    # Equal rows meet the same partners, so a row's whole content tells whether it met any.
    marks = [F.xxhash64("_a").alias("_h0"), F.xxhash64(F.lit(1), "_a").alias("_h1")]
    alone = ours.filter("_b is null").select("*", *marks)
    alone = alone.join(theirs.select(*marks).distinct(), ["_h0", "_h1"], "left_anti").select("_a", "_b")
    return both.unionByName(alone)


def union_key_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_keys: Sequence[str],
    right_cols: Sequence[str],
    overlap: bool = False,
    at: str | None = None,
) -> DataFrame:
    """Join on ``left_key = key1 OR left_key = key2 ...`` as one equality join.

    The right side is repeated once per key column, each copy exposing that column
    as text; a row whose keys are equal is kept once. ``overlap`` clips validity
    intervals, ``at`` picks the version valid at that left column.
    """
    ref = "_ref"
    keyed = None
    for i, key in enumerate(right_keys):
        copy = right.withColumn(ref, F.col(key).cast("string"))
        for earlier in right_keys[:i]:
            copy = copy.filter(~F.col(ref).eqNullSafe(F.col(earlier).cast("string")))
        keyed = copy if keyed is None else keyed.unionByName(copy)
    if overlap:
        return interval_join(left, keyed, [(left_key, ref)], "inner", right_cols)
    if at is not None:
        return pit_join(left, keyed, [(left_key, ref)], at, "inner", right_cols)
    renamed = looked_up(keyed.select(ref, *[F.col(c).alias(f"_u_{c}") for c in right_cols]), row_count(right))
    joined = left.join(renamed, F.col(left_key) == F.col(ref), "inner")
    return joined.select(*left.columns, *[F.col(f"_u_{c}").alias(c) for c in right_cols])

