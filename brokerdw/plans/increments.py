"""Dimensions, incremental form: one batch merged into the stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brokerdw.functions import exprs as X
from brokerdw.operators.grouping import top1
from brokerdw.operators.joins import coalesce_outer, name_match_join
from brokerdw.operators.merge import Scd2Merge, merge, propagate_versions, scd2_merge
from brokerdw.operators.temporal import current_join
from brokerdw.plans.dimensions import (
    ACCOUNT_REFS,
    ACCOUNT_TABLE,
    CLOSED_TRADE,
    CUSTOMER_TABLE,
    DEMOGRAPHICS,
    PROSPECT_MATCH,
    SECURITY_REFS,
    TRADE_TABLE,
    one_prospect_per_address,
    trade_attributes,
    trade_columns,
    with_tax_rates,
)
from brokerdw.plans.stages import CUSTOMER_FILL

# Warehouse columns of a customer that a missing value takes from the previous version.
KEPT_CUSTOMER = [c for c in CUSTOMER_FILL if c not in ("lcl_tx_id", "nat_tx_id", "gender")] + [
    "nationaltaxratedesc",
    "nationaltaxrate",
    "localtaxratedesc",
    "localtaxrate",
]


def prospect_updates(stage: DataFrame, batch: int, current: DataFrame) -> DataFrame:
    """Demographics of current customers changed by the prospect file of a batch.

    A new or changed prospect sets them; one that is no longer listed clears them.
    """
    moved = stage.filter(
        (F.col("batchid") == batch) | ((F.col("recordbatchid") == batch - 1) & (F.col("batchid") < batch))
    )
    newest = top1(moved, ["agencyid"], ["batchid", "recordbatchid"])
    listed = F.col("batchid") == batch
    valued = newest.withColumn("listed", listed)
    sets = [F.when(F.col("listed"), F.col(f"p_{c}")).alias(c) for c in DEMOGRAPHICS]
    renamed = one_prospect_per_address(valued).withColumnsRenamed({c: f"p_{c}" for c in DEMOGRAPHICS})
    keys = ["customerid", *PROSPECT_MATCH, "addressline2"]
    matched = name_match_join(
        current.select(*keys),
        renamed,
        PROSPECT_MATCH,
        ["addressline2"],
        "inner",
        ["listed", *[f"p_{c}" for c in DEMOGRAPHICS]],
    )
    return matched.select("customerid", *sets)


def customer_batch(
    changes: DataFrame, batch: int, current: DataFrame, tax_rate: DataFrame, prospects: DataFrame, batch_date: DataFrame
) -> DataFrame:
    """Change rows of one batch in warehouse columns.

    Names and addresses missing in a change are taken from the current version before
    the prospect is looked up.
    """
    old = current.select("customerid", *[F.col(c).alias(f"o_{c}") for c in [*PROSPECT_MATCH, "addressline2", "gender"]])
    rows = changes.filter(F.col("batchid") == batch).join(batch_date, "batchid").join(old, "customerid", "left")
    filled = rows.withColumns(
        {c: F.coalesce(F.col(c), F.col(f"o_{c}")) for c in [*PROSPECT_MATCH, "addressline2", "gender"]}
    )
    taxed = with_tax_rates(filled, tax_rate)
    visible = prospects.filter((F.col("batchid") <= batch) & (F.col("recordbatchid") >= batch))
    matched = name_match_join(
        taxed, one_prospect_per_address(visible), PROSPECT_MATCH, ["addressline2"], right_cols=DEMOGRAPHICS
    )
    dated = matched.withColumns({"effectivedate": F.col("batchdate"), "gender": X.norm_gender("gender")})
    return dated.select(*[c for c in CUSTOMER_TABLE if c not in ("sk_customerid", "iscurrent", "enddate")])


def merge_dim_customer(
    target: DataFrame, changes: DataFrame, batch: int, tax_rate: DataFrame, prospects: DataFrame, batch_date: DataFrame
) -> Scd2Merge:
    current = target.filter("iscurrent")
    rows = customer_batch(changes, batch, current, tax_rate, prospects, batch_date)
    return scd2_merge(
        target,
        rows,
        ["customerid"],
        KEPT_CUSTOMER,
        ("sk_customerid", "customerid"),
        inplace=prospect_updates(prospects, batch, current),
        inplace_cols=DEMOGRAPHICS,
    )


def account_batch(
    changes: DataFrame,
    batch: int,
    accounts: DataFrame,
    customers: DataFrame,
    dim_broker: DataFrame,
    batch_date: DataFrame,
) -> DataFrame:
    """Changes of one batch: account records, and accounts moved by a new customer version."""
    rows = changes.filter(F.col("batchid") == batch).join(batch_date, "batchid")
    owned = current_join(rows, customers, "customerid", dim_cols=["sk_customerid"])
    brokers = dim_broker.select("brokerid", "sk_brokerid")
    direct = owned.join(brokers, "brokerid", "left").filter(
        F.col("brokerid").isNull() | F.col("sk_brokerid").isNotNull()
    )
    opened = customers.filter(F.col("iscurrent") & (F.col("batchid") == batch))
    closed = customers.filter(~F.col("iscurrent") & (F.col("batchid") < batch))
    forced = propagate_versions(accounts, closed, opened, "customerid", "sk_customerid")
    cols = ["sk_brokerid", "sk_customerid", "accountdesc", "taxstatus", "status", "effectivedate"]
    direct = direct.withColumn("effectivedate", F.col("batchdate")).select("accountid", *cols)
    both = coalesce_outer(direct, forced.select("accountid", *cols), ["accountid"], cols)
    return both.withColumn("batchid", F.lit(batch))


def merge_dim_account(
    target: DataFrame,
    changes: DataFrame,
    batch: int,
    customers: DataFrame,
    dim_broker: DataFrame,
    batch_date: DataFrame,
) -> Scd2Merge:
    rows = account_batch(changes, batch, target, customers, dim_broker, batch_date)
    return scd2_merge(
        target.select(*ACCOUNT_TABLE),
        rows,
        ["accountid"],
        ["sk_brokerid", "accountdesc", "taxstatus", "status"],
        ("sk_accountid", "accountid"),
    )


def trade_batch(trades: DataFrame, batch: int) -> DataFrame:
    """Latest record of each trade of a batch; creation only from inserted rows."""
    rows = trades.filter(F.col("batchid") == batch).withColumns(
        {
            "create_ts": F.when(F.col("cdc_flag") == "I", F.col("t_dts")),
            "close_ts": F.when(F.col("status").isin(CLOSED_TRADE), F.col("t_dts")),
        }
    )
    created = rows.groupBy("tradeid").agg(
        F.min("create_ts").alias("create_ts"),
        F.max_by(
            F.struct("close_ts", "status", *trade_attributes()), F.struct("t_dts", "cdc_dsn")
        ).alias("last"),
    )
    return created.select("tradeid", "create_ts", "last.*", F.lit(batch).alias("batchid"))


def merge_dim_trade(
    target: DataFrame,
    trades: DataFrame,
    batch: int,
    dim_security: DataFrame,
    dim_account: DataFrame,
    closed: DataFrame | None = None,
) -> DataFrame:
    """Open trades are updated, unknown ones inserted; a closed trade is left alone.

    ``target`` may be the open trades only; ``closed`` then holds the closed ones, of
    which just the key is read. The result is the open trades and those closed now.
    """
    rows = trade_batch(trades, batch)
    secured = current_join(rows, dim_security, [("t_s_symb", "symbol")], dim_cols=SECURITY_REFS)
    joined = current_join(secured, dim_account, [("t_ca_id", "accountid")], dim_cols=ACCOUNT_REFS)
    source = trade_columns(joined).select(*TRADE_TABLE)
    if closed is not None:
        source = source.join(closed.select("tradeid"), "tradeid", "left_anti")
    updated = [
        "sk_closedateid", "sk_closetimeid", "status", "type", "cashflag", "quantity", "bidprice", "executedby",
        "tradeprice", "fee", "commission", "tax", "batchid",
    ]
    still_open = F.col("t_sk_closedateid").isNull() & F.col("t_sk_closetimeid").isNull()
    return merge(
        target.select(*TRADE_TABLE),
        source,
        ["tradeid"],
        matched=[(still_open, {c: F.col(f"s_{c}") for c in updated})],
    )
