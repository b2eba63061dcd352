"""What one batch leaves to the next, so that a batch's cost follows its own rows.

A batch reads its own files and a state with a bounded number of rows a key: the closing
balance of an account, the last year of quotes of a symbol, the first and last batch of a
prospect record. Rows that come late, dated before what the state holds, need more than the
state: only their keys are taken from the stored days of earlier batches again. A batch's
rows are what one run over all batches up to it gives for them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brokerdw.operators.hotkeys import stored
from brokerdw.plans import stages

YEAR = 364  # quotes before a quote that its extremes look at
QUOTE_KEY, QUOTE_ORDER = "dm_s_symb", ["dm_date", "batchid"]


def _keyed(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Join on one key, a null key being a key like others."""
    named = right.withColumnRenamed(key, "_key")
    return left.join(named, F.col(key).eqNullSafe(F.col("_key")), how).drop("_key")


# -- balances -----------------------------------------------------------------


def cash_days(cash: DataFrame) -> DataFrame:
    """accountid, day, batchid, total: the transactions of a batch, added up by account and day."""
    total = F.sum(F.col("ct_amt").cast("decimal(28,4)")).alias("total")
    return cash.groupBy("accountid", F.to_date("ct_dts").alias("day"), "batchid").agg(total)


def close_balances(days: DataFrame, closing: DataFrame | None = None) -> DataFrame:
    """accountid, last_day, closing after the days of one more batch."""
    rows = days.select("accountid", F.col("day").alias("last_day"), F.col("total").alias("closing"))
    rows = rows if closing is None else closing.unionByName(rows)
    return rows.groupBy("accountid").agg(F.max("last_day").alias("last_day"), F.sum("closing").cast("decimal(38,4)").alias("closing"))


def _balances(days: DataFrame) -> DataFrame:
    upto = Window.partitionBy("accountid").orderBy("day").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return days.withColumn("balance", F.sum("total").over(upto))


def cash_after(days: DataFrame, closing: DataFrame, earlier: DataFrame) -> DataFrame:
    """The balances of a batch (as :func:`stages.cash_stage` gives them).

    ``days`` are the batch's, ``closing`` the state before it, ``earlier`` the stored days of
    the batches before, which are read for accounts with late days only.
    """
    shown = ["accountid", F.col("day").alias("datevalue"), F.col("balance").cast("double").alias("cash"), "batchid"]
    met = _keyed(days, closing, "accountid", "left")

    def opened(rows: DataFrame) -> DataFrame:
        """A null amount adds nothing; an account without any amount has no balance."""
        return _balances(rows).withColumn("balance", F.coalesce(F.col("closing") + F.col("balance"), "closing", "balance"))

    is_late = F.coalesce(F.col("day") < F.col("last_day"), F.col("day").isNull() & F.col("closing").isNotNull())
    late = stored(met.filter(is_late).select("accountid").distinct(), "late-accounts")
    if late.isEmpty():
        return opened(met).select(*shown)
    in_order = opened(_keyed(met, late, "accountid", "left_anti"))
    both = days.withColumn("_new", F.lit(True)).unionByName(earlier.select(*days.columns).withColumn("_new", F.lit(False)))
    again = _balances(_keyed(both, late, "accountid", "left_semi")).filter("_new")
    return in_order.select(*shown).unionByName(again.select(*shown))


# -- quotes -------------------------------------------------------------------


def quote_tails(quotes: DataFrame, tails: DataFrame | None = None, rows: int = YEAR) -> DataFrame:
    """The last ``rows`` quotes of each symbol after one more batch; a symbol has as many rows in the state at most."""
    cols = [QUOTE_KEY, *QUOTE_ORDER, "dm_low", "dm_high"]
    both = quotes.select(*cols) if tails is None else tails.select(*cols).unionByName(quotes.select(*cols))
    newest = Window.partitionBy(QUOTE_KEY).orderBy(*[F.desc(c) for c in QUOTE_ORDER])
    return both.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= rows).drop("_n")


def market_after(quotes: DataFrame, tails: DataFrame, earlier: DataFrame, preceding: int = YEAR) -> DataFrame:
    """The quotes of a batch with the extremes of the year before (as :func:`stages.daily_market_stage` gives them).

    ``earlier`` are the stored quotes of the batches before. They are read for symbols with a
    late quote whose state is full, as only then an earlier quote can be missing.
    """
    full = tails.groupBy(QUOTE_KEY).agg(F.max("dm_date").alias("_last"), F.count("*").alias("_rows")).filter(F.col("_rows") >= preceding)
    met = _keyed(quotes.select(QUOTE_KEY, "dm_date"), full, QUOTE_KEY, "inner")
    late = stored(met.filter(F.coalesce(F.col("dm_date") < F.col("_last"), F.lit(True))).select(QUOTE_KEY).distinct(), "late-symbols")

    def found(before: DataFrame, new: DataFrame) -> DataFrame:
        rows = before.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)), allowMissingColumns=True)
        out = stages.daily_market_stage(rows.select(*quotes.columns, "_new"), preceding)
        return out.filter("_new").drop("_new")

    if late.isEmpty():
        return found(tails, quotes)
    pick = lambda df, how: _keyed(df, late, QUOTE_KEY, how)
    in_order = found(pick(tails, "left_anti"), pick(quotes, "left_anti"))
    return in_order.unionByName(found(pick(earlier, "left_semi"), pick(quotes, "left_semi")))


# -- snapshots ----------------------------------------------------------------


def seen_after(state: DataFrame, snapshot: DataFrame, derived: Sequence[str] = (), batch: str = "batchid", last: str = "recordbatchid") -> DataFrame:
    """Distinct records with the first and the last batch showing them, after one more snapshot.

    ``derived`` are columns of the state that depend on the record only; they are left out.
    """
    cols = [c for c in state.columns if c not in (batch, last, *derived)]
    rows = state.select(*cols, batch, last).unionByName(snapshot.select(*cols, batch, F.col(batch).alias(last)))
    return rows.groupBy(*cols).agg(F.max(last).alias(last), F.min(batch).alias(batch))
