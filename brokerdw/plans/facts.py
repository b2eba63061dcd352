"""Facts and the prospect table; each serves the historical and the incremental load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brokerdw.functions import exprs as X
from brokerdw.operators.grouping import placed_removed, snapshot_as_of
from brokerdw.operators.hotkeys import looked_up, row_count
from brokerdw.operators.joins import name_match_join
from brokerdw.operators.merge import merge
from brokerdw.operators.temporal import current_join, pit_join
from brokerdw.plans.dimensions import PROSPECT_MATCH

HOLDING_REFS = ["sk_customerid", "sk_accountid", "sk_securityid", "sk_companyid"]


def build_prospect(stage: DataFrame, batch: int, dim_customer: DataFrame, batch_date: DataFrame) -> DataFrame:
    """Prospects visible at a batch, flagged if they are current customers."""
    seen = snapshot_as_of(stage, batch)
    keys = dim_customer.filter("iscurrent").select(*PROSPECT_MATCH, "addressline2")
    keys = keys.select(
        *[X.match_key(c).alias(c) for c in PROSPECT_MATCH], X.match_key("addressline2", True).alias("addressline2")
    ).distinct()
    flagged = name_match_join(
        seen, looked_up(keys.withColumn("found", F.lit(True)), row_count(dim_customer)), PROSPECT_MATCH, ["addressline2"], right_cols=["found"]
    )
    dates = lambda name, key: batch_date.select(
        F.col("batchid").alias(key), X.date_key("batchdate").alias(name)
    )
    joined = flagged.join(dates("sk_recorddateid", "recordbatchid"), "recordbatchid").join(
        dates("sk_updatedateid", "batchid"), "batchid"
    )
    record = [c for c in stage.columns if c not in ("agencyid", "batchid", "recordbatchid")]
    return joined.select(
        "agencyid",
        "sk_recorddateid",
        "sk_updatedateid",
        "batchid",
        F.coalesce("found", F.lit(False)).alias("iscustomer"),
        *record,
    )


def build_fact_holdings(holdings: DataFrame, dim_trade: DataFrame) -> DataFrame:
    """Holdings changed by a trade, with the keys, price and closing time of that trade."""
    trade = dim_trade.select(
        F.col("tradeid").alias("currenttradeid"),
        *HOLDING_REFS,
        F.col("sk_closedateid").alias("sk_dateid"),
        F.col("sk_closetimeid").alias("sk_timeid"),
        F.col("tradeprice").alias("currentprice"),
    )
    rows = holdings.select(
        F.col("hh_h_t_id").cast("bigint").alias("tradeid"),
        F.col("hh_t_id").cast("bigint").alias("currenttradeid"),
        F.col("hh_after_qty").alias("currentholding"),
        "batchid",
    )
    return rows.join(trade, "currenttradeid").select(
        "tradeid", "currenttradeid", *HOLDING_REFS, "sk_dateid", "sk_timeid", "currentprice", "currentholding", "batchid"
    )


def build_fact_cash_balances(stage: DataFrame, dim_account: DataFrame, current: bool = False) -> DataFrame:
    """Balances keyed by the account version of the day, or the current one for later batches."""
    refs = ["sk_customerid", "sk_accountid"]
    if current:
        joined = current_join(stage, dim_account, "accountid", dim_cols=refs)
    else:
        joined = pit_join(stage, dim_account, "accountid", "datevalue", dim_cols=refs)
    return joined.select(*refs, X.date_key("datevalue").alias("sk_dateid"), "cash", "batchid")


def build_fact_market_history(
    stage: DataFrame, dim_security: DataFrame, company_eps: DataFrame, current: bool = False
) -> DataFrame:
    """Daily quotes with price-earnings ratio, yield and 52-week extremes."""
    refs = ["sk_securityid", "sk_companyid", "dividend"]
    on = [("dm_s_symb", "symbol")]
    if current:
        joined = current_join(stage, dim_security, on, dim_cols=refs)
    else:
        joined = pit_join(stage, dim_security, on, "dm_date", dim_cols=refs)
    eps = company_eps.select(
        F.col("sk_companyid").alias("eps_company"),
        F.year("fi_qtr_start_date").alias("eps_year"),
        F.quarter("fi_qtr_start_date").alias("eps_qtr"),
        "sum_fi_basic_eps",
    )
    same_quarter = (
        (F.col("sk_companyid") == F.col("eps_company"))
        & (F.year("dm_date") == F.col("eps_year"))
        & (F.quarter("dm_date") == F.col("eps_qtr"))
    )
    return joined.join(eps, same_quarter, "left").select(
        "sk_securityid",
        "sk_companyid",
        X.date_key("dm_date").alias("sk_dateid"),
        F.try_divide("dm_close", "sum_fi_basic_eps").alias("peratio"),
        (F.try_divide("dividend", "dm_close") / 100).alias("yield"),
        "fiftytwoweekhigh",
        "sk_fiftytwoweekhighdate",
        "fiftytwoweeklow",
        "sk_fiftytwoweeklowdate",
        F.col("dm_close").alias("closeprice"),
        F.col("dm_high").alias("dayhigh"),
        F.col("dm_low").alias("daylow"),
        F.col("dm_vol").alias("volume"),
        "batchid",
    )


def watch_stage(watches: DataFrame, ignore_cancel: bool = True) -> DataFrame:
    """Placement and removal day of each customer and symbol."""
    found = placed_removed(
        watches, ["w_c_id", "w_s_symb"], "w_dts", "w_action", "CNCL", ignore_cancel, [F.min("batchid").alias("batchid")]
    )
    return found.select(
        F.col("w_c_id").alias("customerid"),
        F.col("w_s_symb").alias("symbol"),
        F.to_date("placed").alias("dateplaced"),
        F.to_date("removed").alias("dateremoved"),
        "batchid",
    )


def _watch_columns(joined: DataFrame) -> DataFrame:
    return joined.select(
        "sk_customerid",
        "sk_securityid",
        X.date_key("dateplaced").alias("sk_dateid_dateplaced"),
        X.date_key("dateremoved").alias("sk_dateid_dateremoved"),
        "batchid",
    )


def build_fact_watches(stage: DataFrame, dim_security: DataFrame, dim_customer: DataFrame) -> DataFrame:
    placed = stage.filter(F.col("dateplaced").isNotNull())
    secured = pit_join(placed, dim_security, "symbol", "dateplaced", dim_cols=["sk_securityid"])
    return _watch_columns(pit_join(secured, dim_customer, "customerid", "dateplaced", dim_cols=["sk_customerid"]))


def merge_fact_watches(
    target: DataFrame, batch: DataFrame, dim_security: DataFrame, dim_customer: DataFrame
) -> DataFrame:
    """Add the watches placed in a batch and close the open ones it cancels.

    The fact holds surrogate keys only, so open rows are led back to customer number
    and symbol through the dimensions before cancellations can find them.
    """
    placed = batch.filter(F.col("dateplaced").isNotNull())
    added = _watch_columns(
        current_join(
            current_join(placed, dim_security, "symbol", dim_cols=["sk_securityid"]),
            dim_customer,
            "customerid",
            dim_cols=["sk_customerid"],
        )
    )
    cancels = batch.filter(F.col("dateplaced").isNull()).select("customerid", "symbol", "dateremoved", "batchid")
    open_rows = target.filter(F.col("sk_dateid_dateremoved").isNull()).select("sk_customerid", "sk_securityid")
    named = open_rows.join(dim_customer.select("sk_customerid", "customerid"), "sk_customerid").join(
        dim_security.select("sk_securityid", "symbol"), "sk_securityid"
    )
    closing = named.join(cancels, ["customerid", "symbol"]).select(
        "sk_customerid",
        "sk_securityid",
        X.date_key("dateremoved").alias("sk_dateid_dateremoved"),
        "batchid",
    )
    closed = merge(
        target,
        closing,
        ["sk_customerid", "sk_securityid"],
        matched=[
            (None, {"sk_dateid_dateremoved": F.col("s_sk_dateid_dateremoved"), "batchid": F.col("s_batchid")})
        ],
        insert=False,
        eligible=F.col("t_sk_dateid_dateremoved").isNull(),
    )
    return closed.unionByName(added)
