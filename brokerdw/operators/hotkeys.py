"""Windows and interval joins that survive a key holding a large share of the rows.

A window partitioned by a key alone puts all rows of that key in one task. Here a
key with more rows than one task should sort is cut into cells along its ordering
column; windows then run per (key, cell), and the little that crosses a cell border
(a carried value, a row offset, a few neighbour rows) is exchanged separately. Keys
below the limit keep the plain one-shuffle plan.

Cells are the ranges into which Spark's range partitioning deals the hot keys' rows by key
and place. The rows are stored with the number of their range, so every later step sees the
same cells; no row carries the borders, and no task gathers the rows of a key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brokerdw.session import scratch_dir

# A key with more rows than one task should sort is cut into cells.
HOT_ROWS = 2_000_000
# A key with more validity intervals than one row should be compared with is cut in interval joins.
HOT_VERSIONS = 1_000
# Cells per ``limit`` rows of hot keys; beyond FEW_CELLS a cell has LEAST_ROWS rows on average, however low the limit.
CELLS, FEW_CELLS, LEAST_ROWS = 4, 32, 10_000
# A mark list of at most this many keys is broadcast; a longer one is joined like any table.
BROADCAST_MARKS = 1_000
# A table of more rows than this is sorted and merged with those that look it up, never sent whole to every executor.
LOOKUP_ROWS = 100_000
# Results of counting that are remembered, by plan, keys and limit.
REMEMBERED = 256

CELL = "_cell"
BLOCK, HALO = "_block", "_halo"


@dataclass(frozen=True)
class HotKeys:
    """The keys with many rows: ``marks`` has a row per key, ``_hot0..``, and nothing that grows with a key's rows."""

    keys: tuple[str, ...]
    marks: DataFrame | None
    count: int = 0
    rows: int = 0  # of all hot keys together
    limit: int = 1
    has_null: bool = False  # a null key is hot itself, so joins on the keys must be null-safe

    def __bool__(self) -> bool:
        return self.count > 0

    def on(self, keys: Sequence[str]) -> HotKeys:
        """The same marks for a frame whose key columns are named ``keys``."""
        return replace(self, keys=tuple(keys))


# For inputs whose rows per key are bounded by construction (one row per key and day).
NO_HOT = HotKeys((), None)


def ordinal(df: DataFrame, column: str) -> Column:
    """A long that grows with ``column`` (date, timestamp or number)."""
    kind = df.schema[column].dataType
    c = F.col(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, T.NumericType):
        return F.floor(c).cast("long")
    raise TypeError(f"{column}: the first ordering column must be a date, timestamp or number")


def _conf_rows(df: DataFrame, name: str, default: int) -> int:
    return int(df.sparkSession.conf.get(name, str(default)))


def hot_window_keys(df: DataFrame, keys: Sequence[str]) -> HotKeys:
    """Keys of a window input with more rows than one task should sort.

    The row limit can be set per session with ``brokerdw.hotRows``.
    """
    return find_hot_keys(df, keys, _conf_rows(df, "brokerdw.hotRows", HOT_ROWS))


def find_hot_keys(df: DataFrame, keys: Sequence[str], limit: int) -> HotKeys:
    """Count rows per key (combined map-side, key columns only) and mark those with more than ``limit``.

    The usual answer, that there is none, takes one job and writes nothing. An equal plan is
    counted once a session: marks only choose between plans that give the same rows.
    """
    names = [f"_hot{i}" for i in range(len(keys))]
    keyed = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)])
    known = (df.sparkSession.sparkContext.applicationId, keyed.semanticHash(), limit)
    if known in _COUNTED:
        return _COUNTED[known].on(keys)
    counts = keyed.groupBy(*names).agg(F.count("*").alias("_n"))
    many = F.col("_n") > limit
    nulls = F.coalesce(F.max(many & F.greatest(*[F.col(n).isNull() for n in [*names, names[0]]])), F.lit(False))
    size = counts.agg(
        F.count_if(many).alias("n"), F.sum(F.when(many, F.col("_n"))).alias("rows"), nulls.alias("null"), F.sum("_n").alias("all")
    ).first()
    found = NO_HOT
    if size["n"]:
        marks = stored(counts.filter(many).select(*names), "hot-keys")
        found = HotKeys(tuple(keys), marks, size["n"], size["rows"], limit, bool(size["null"]))
    _remember(_COUNTED, known, found)
    _remember(_ROWS, known[:2], size["all"] or 0)
    return found


def _remember(counted: dict, known: tuple, value) -> None:
    while len(counted) >= REMEMBERED:
        counted.pop(next(iter(counted)))
    counted[known] = value


_COUNTED: dict[tuple[str, int, int], HotKeys] = {}
_ROWS: dict[tuple[str, int], int] = {}


def row_count(df: DataFrame, keys: Sequence[str] = ()) -> int:
    """Rows of ``df``, counted once a session for a plan; of a stored table that reads the ends of its files only.

    With the ``keys`` of :func:`find_hot_keys` its counts are taken.
    """
    counted = df.select(*[F.col(k).alias(f"_hot{i}") for i, k in enumerate(keys)]) if keys else df
    known = (df.sparkSession.sparkContext.applicationId, counted.semanticHash())
    if known not in _ROWS:
        _remember(_ROWS, known, df.count())
    return _ROWS[known]


def looked_up(df: DataFrame, rows: int) -> DataFrame:
    """``df``, made from a table of ``rows`` rows, as a side of a join: sorted and merged if they are many.

    Spark estimates a table by the size of its files and the share of its columns' widths that
    a join reads. The repeated texts of a wide dimension pack to almost nothing and its keys do
    not, so the estimate of the keys alone can be a fiftieth of their size, and a broadcast
    that Spark takes for small would not fit into the driver.
    """
    return df.hint("merge") if rows > _conf_rows(df, "brokerdw.lookupRows", LOOKUP_ROWS) else df


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _broadcast(marks: DataFrame, count: int) -> DataFrame:
    return F.broadcast(marks) if count <= BROADCAST_MARKS else marks


def split_hot(df: DataFrame, keys: Sequence[str], hot: HotKeys) -> tuple[DataFrame, DataFrame]:
    """The rows of ordinary keys and those of hot ones."""
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_hot{i}"))
    marks = _broadcast(hot.marks, hot.count)
    return df.join(marks, on, "left_anti"), df.join(marks, on, "left_semi")


def with_cells(df: DataFrame, keys: Sequence[str], order_by: str | Sequence[str], hot: HotKeys) -> DataFrame:
    """Add ``_cell``: 0 for ordinary keys, for hot ones a number that grows along the order.

    Rows of one key and place share a cell.
    """
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    cold, many = split_hot(df, keys, hot)
    ranges = max(2, min(-(-hot.rows * CELLS // hot.limit), max(FEW_CELLS, hot.rows // LEAST_ROWS)))
    dealt = many.repartitionByRange(ranges, *keys, *order_by).withColumn(CELL, F.spark_partition_id().cast("long") + 1)
    return cold.withColumn(CELL, F.lit(0).cast("long")).unionByName(stored(dealt, "hot-cells"))


def _join_small(df: DataFrame, small: DataFrame, keys: Sequence[str], hot: HotKeys) -> DataFrame:
    """Left join on (keys, cell); ``small`` has one row per hot cell.

    Plain equality lets the join reuse the window's partitioning; only a
    dominating null key needs the null-safe form.
    """
    renamed = small
    names = [*keys, CELL]
    for i, name in enumerate(names):
        renamed = renamed.withColumnRenamed(name, f"_j{i}")
    on = F.col(CELL) == F.col(f"_j{len(keys)}")
    for i, name in enumerate(keys):
        other = F.col(f"_j{i}")
        on = on & (F.col(name).eqNullSafe(other) if hot.has_null else F.col(name) == other)
    return df.join(renamed, on, "left").drop(*[f"_j{i}" for i in range(len(names))])


def carry_last(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    cols: Sequence[str],
    hot: HotKeys | None = None,
) -> DataFrame:
    """Replace each of ``cols`` by its last non-null value up to the row."""
    hot = hot_window_keys(df, keys) if hot is None else hot
    so_far = lambda w: w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if not hot:
        w = so_far(Window.partitionBy(*keys).orderBy(*order_by))
        return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})

    celled = with_cells(df, keys, order_by, hot)
    rank = F.struct(*order_by)
    tails = (
        celled.filter(F.col(CELL) > 0)
        .groupBy(*keys, CELL)
        .agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), rank)).alias(f"_t_{c}") for c in cols])
    )
    before = Window.partitionBy(*keys).orderBy(CELL).rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(
        *keys, CELL, *[F.last(f"_t_{c}", ignorenulls=True).over(before).alias(f"_c_{c}") for c in cols]
    )
    w = so_far(Window.partitionBy(*keys, CELL).orderBy(*order_by))
    local = celled.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})
    joined = _join_small(local, carried, keys, hot)
    filled = joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_c_{c}")) for c in cols})
    return filled.select(*df.columns)


def row_positions(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], hot: HotKeys, name: str = "_pos"
) -> DataFrame:
    """Row number per key (from 1), hot keys numbered cell by cell plus an offset."""
    celled = with_cells(df, keys, order_by, hot)
    counts = celled.filter(F.col(CELL) > 0).groupBy(*keys, CELL).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy(CELL).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, CELL, F.sum("_n").over(before).alias("_off"))
    w = Window.partitionBy(*keys, CELL).orderBy(*order_by)
    numbered = celled.withColumn("_rn", F.row_number().over(w))
    return (
        _join_small(numbered, offsets, keys, hot)
        .withColumn(name, F.col("_rn") + F.coalesce(F.col("_off"), F.lit(0)))
        .drop("_rn", "_off")
    )


def bounded_window(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    exprs: dict[str, Callable[[WindowSpec], Column]],
    preceding: int = 0,
    following: int = 0,
    hot: HotKeys | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Window expressions that look at most ``preceding`` / ``following`` rows away.

    A hot key is cut into blocks of consecutive rows; each block also receives
    copies of the neighbour rows its frames reach, which are dropped afterwards.
    """
    hot = hot_window_keys(df, keys) if hot is None else hot
    if not hot:
        w = Window.partitionBy(*keys).orderBy(*order_by)
        return df.withColumns({name: make(w) for name, make in exprs.items()})

    spread = spread_blocks(df, keys, order_by, preceding, following, hot, block_rows)
    w = Window.partitionBy(*keys, BLOCK).orderBy(*order_by)
    done = spread.withColumns({name: make(w) for name, make in exprs.items()})
    new = [name for name in exprs if name not in df.columns]
    return done.filter(~F.col(HALO)).select(*df.columns, *new)


def spread_blocks(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    preceding: int,
    following: int,
    hot: HotKeys,
    block_rows: int | None = None,
) -> DataFrame:
    """Cut hot keys into blocks of consecutive rows, adding the neighbours their frames reach.

    ``_block`` joins the key as partition column; copies are marked by ``_halo``.
    """
    reach = max(preceding, following, 1)
    size = max(block_rows or _conf_rows(df, "brokerdw.hotRows", HOT_ROWS), 4 * reach)
    placed = row_positions(df, keys, order_by, hot)
    block = F.floor((F.col("_pos") - 1) / size)
    offset = (F.col("_pos") - 1) % size
    copy = lambda b, halo: F.struct(b.cast("long").alias("b"), F.lit(halo).alias("halo"))
    to_next = F.when(offset >= size - preceding, copy(block + 1, True))
    to_prev = F.when((offset < following) & (block > 0), copy(block - 1, True))
    copies = F.when(F.col(CELL) == 0, F.array(copy(F.lit(0), False))).otherwise(
        F.array_compact(F.array(copy(block, False), to_next, to_prev))
    )
    return placed.withColumn("_copy", F.explode(copies)).select(
        *df.columns, F.col("_copy.b").alias(BLOCK), F.col("_copy.halo").alias(HALO)
    )


def running(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    column: str,
    name: str,
    how: str = "sum",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add the sum or maximum of ``column`` over the key's rows before the row (null before the first)."""
    hot = hot_window_keys(df, keys) if hot is None else hot
    combine = {"sum": F.sum, "max": F.max}[how]
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    if not hot:
        return df.withColumn(name, combine(column).over(before(Window.partitionBy(*keys).orderBy(*order_by))))
    celled = with_cells(df, keys, order_by, hot)
    wholes = celled.filter(F.col(CELL) > 0).groupBy(*keys, CELL).agg(combine(column).alias("_whole"))
    carried = wholes.select(*keys, CELL, combine("_whole").over(before(Window.partitionBy(*keys).orderBy(CELL))).alias("_carried"))
    local = celled.withColumn(name, combine(column).over(before(Window.partitionBy(*keys, CELL).orderBy(*order_by))))
    joined = _join_small(local, carried, keys, hot)
    both = F.col("_carried") + F.col(name) if how == "sum" else F.greatest("_carried", name)
    return joined.withColumn(name, F.coalesce(both, name, "_carried")).select(*df.columns, name)
