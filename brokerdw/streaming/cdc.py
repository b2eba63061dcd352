"""Automatic change application, type 1 and type 2, for batch and streaming sources.

Both keep a log whose combination is associative, commutative and idempotent, so
rows may arrive late, twice or in any order. Of several rows of one key and sequence one
row wins as a whole: the one whose text has the largest MD5 digest. A micro-batch either
appends its combined rows, and readers combine the log, which :meth:`TableStore.compact` folds
now and then; or the log is laid out by key, and a micro-batch folds and sequences the
buckets that its keys are in, see :class:`ByKey`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brokerdw.functions.exprs import open_end
from brokerdw.operators.hotkeys import HotKeys, bounded_window, carry_last, stored
from brokerdw.operators.temporal import CURRENT, END, START
from brokerdw.sources.store import BUCKETS, TableStore

SEQ, TIE = "_seq", "_tie"


def row_rank(cols: Sequence[str]) -> Column:
    """Orders rows of equal sequence by content: 60 bits of the MD5 digest of the values' text."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


# -- type 1 -------------------------------------------------------------------
def _data_cols(df: DataFrame, keys: Sequence[str], sequence_by: str, except_cols: Sequence[str]) -> list[str]:
    skip = {*keys, *except_cols}
    if sequence_by in except_cols:
        skip.add(sequence_by)
    return [c for c in df.columns if c not in skip]


def scd1_log(
    batch: DataFrame, keys: Sequence[str], sequence_by: str, ignore_nulls: bool = True, except_cols: Sequence[str] = ()
) -> DataFrame:
    """Latest value of every column with its own sequence number, one row per key.

    Without ``ignore_nulls`` all values of a key come from one row. With it a null never
    replaces a value, so each column keeps the sequence at which it was last set and a
    late row can still fill a gap; ties are settled by the same row order in every column.
    """
    cols = _data_cols(batch, keys, sequence_by, except_cols)
    ranked = batch.withColumn(TIE, row_rank([c for c in batch.columns if c not in (*keys, sequence_by)]))

    def versioned(c: str) -> Column:
        entry = F.struct(F.col(sequence_by).alias("seq"), F.col(TIE).alias("tie"), F.col(c).alias("val"))
        return F.max(F.when(F.col(c).isNotNull(), entry) if ignore_nulls else entry).alias(c)

    return ranked.groupBy(*keys).agg(*[versioned(c) for c in cols])


def combine_scd1(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fold several log rows of a key into one."""
    cols = [c for c in log.columns if c not in keys]
    return log.groupBy(*keys).agg(*[F.max(c).alias(c) for c in cols])


def scd1_view(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The visible type 1 table of a log."""
    folded = combine_scd1(log, keys)
    return folded.select(*keys, *[F.col(f"{c}.val").alias(c) for c in folded.columns if c not in keys])


def apply_changes_scd1(
    state: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    ignore_nulls: bool = True,
    except_cols: Sequence[str] = (),
) -> DataFrame:
    """New log state after a batch of changes (see :func:`scd1_view` for the table)."""
    new = scd1_log(batch, keys, sequence_by, ignore_nulls, except_cols)
    return new if state is None else combine_scd1(state.unionByName(new), keys)


# -- type 2 -------------------------------------------------------------------
def scd2_log(batch: DataFrame, keys: Sequence[str], sequence_by: str, except_cols: Sequence[str] = ()) -> DataFrame:
    """Change rows as received, one per key and sequence (a repeated row changes nothing)."""
    cols = [c for c in batch.columns if c not in (*keys, sequence_by, *except_cols)]
    ranked = batch.select(*keys, F.col(sequence_by).alias(SEQ), row_rank(cols).alias(TIE), *cols)
    return combine_scd2(ranked, keys)


def combine_scd2(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    cols = [c for c in log.columns if c not in (*keys, SEQ)]
    winner = log.groupBy(*keys, SEQ).agg(F.max(F.struct(TIE, *[c for c in cols if c != TIE])).alias("_row"))
    return winner.select(*keys, SEQ, "_row.*")


def scd2_view(
    log: DataFrame, keys: Sequence[str], ignore_nulls: bool = True, hot: HotKeys | None = None
) -> DataFrame:
    """History of a log with ``__START_AT`` / ``__END_AT`` per version.

    Rows are sequenced by their sequence column, not by arrival, so a late row splits
    the interval it falls into. With ``ignore_nulls`` missing values are filled from
    the version before.
    """
    rows = combine_scd2(log, keys).drop(TIE)
    cols = [c for c in rows.columns if c not in (*keys, SEQ)]
    filled = carry_last(rows, keys, [SEQ], cols, hot) if ignore_nulls else rows
    dated = bounded_window(
        filled, keys, [SEQ], {"__END_AT": lambda w: F.lead(SEQ).over(w)}, following=1, hot=hot
    )
    return dated.withColumnRenamed(SEQ, "__START_AT")


def apply_changes_scd2(
    state: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    except_cols: Sequence[str] = (),
) -> DataFrame:
    """New log state after a batch of changes (see :func:`scd2_view` for the history)."""
    new = scd2_log(batch, keys, sequence_by, except_cols)
    return new if state is None else combine_scd2(state.unionByName(new), keys)


def with_validity(history: DataFrame) -> DataFrame:
    """``__START_AT`` / ``__END_AT`` as ``effectivedate, enddate, iscurrent``."""
    return (
        history.withColumn(START, F.to_date("__START_AT"))
        .withColumn(END, F.coalesce(F.to_date("__END_AT"), open_end()))
        .withColumn(CURRENT, F.col("__END_AT").isNull())
    )


# -- streaming ----------------------------------------------------------------
@dataclass(frozen=True)
class ByKey:
    """Layout of a change log by buckets of its keys.

    ``combine`` folds the log rows of a key. ``view`` makes the visible table of a folded
    log; it is stored beside the log as ``<table>_view``, bucket by bucket.
    """

    keys: Sequence[str]
    combine: Callable[[DataFrame, Sequence[str]], DataFrame]
    view: Callable[[DataFrame, Sequence[str]], DataFrame]
    count: int = BUCKETS


def merge_log(store: TableStore, table: str, log: DataFrame, by: ByKey, flow: str) -> None:
    """Fold log rows into the buckets of their keys and sequence those buckets again; no other is read.

    Log and view are two commits of one flow; what a stopped run has done is not done again.
    """
    view = f"{table}_view"
    if store.has_flow(view, flow):
        return
    log = stored(log, "change-log")
    labels = store.buckets_of(log, by.keys, by.count)
    if not store.has_flow(table, flow):
        old = store.read_buckets(table, labels)
        merged = by.combine(log if old is None else old.unionByName(log), by.keys)
        store.replace_buckets(table, merged.select(*log.columns), by.keys, labels, flow, by.count)
    folded = store.read_buckets(table, labels)
    shown = by.view(log.limit(0) if folded is None else folded, by.keys)
    store.replace_buckets(view, shown, by.keys, labels, flow, by.count)


def run_cdc(
    source: DataFrame,
    store: TableStore,
    table: str,
    to_log: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    once: DataFrame | None = None,
    flow: str = "stream",
    by: ByKey | None = None,
) -> None:
    """Drain a streaming source into a change log.

    ``once`` is loaded a single time before the stream (historical hydration). Every
    micro-batch is reduced by ``to_log`` and appended under its own commit; a batch
    replayed after a failure is recognised by the stream's id, which its checkpoint keeps,
    and the batch's number. A new checkpoint is a new stream: it reads all files again,
    which the log absorbs. Deleting checkpoint and table starts a full refresh.

    With ``by`` the log is laid out by key: a micro-batch folds and sequences the buckets
    that its keys are in, and the visible table ``<table>_view`` is read as it is.
    """

    def load(rows: DataFrame, name: str) -> None:
        if by is not None:
            merge_log(store, table, to_log(rows), by, name)
        elif not store.has_flow(table, name):
            store.write(table, to_log(rows), "append", flow=name)

    if once is not None:
        load(once, f"{flow}-once")
    spark = source.sparkSession

    def append(batch: DataFrame, batch_id: int) -> None:
        stream = spark.read.text(f"{checkpoint}/metadata").first()[0]
        load(batch, f"{flow}-{stream}-{batch_id}")

    query = (
        source.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
