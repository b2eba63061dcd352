"""Dimensions, historical and collective form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brokerdw.functions import exprs as X
from brokerdw.operators.grouping import top1
from brokerdw.operators.hotkeys import hot_window_keys
from brokerdw.operators.joins import name_match_join
from brokerdw.operators.temporal import (
    close_open_versions,
    forward_fill,
    interval_join,
    pit_join,
    scd2_history,
    union_key_join,
)
from brokerdw.plans.stages import ACCOUNT_COLS, ACCOUNT_FILL, CUSTOMER_COLS, CUSTOMER_FILL
from brokerdw.sources.scans import parse_cmp, parse_fin, parse_sec

# Job code of a broker in the employee file.
BROKER_JOB = "314"
CLOSED_TRADE = ["CMPT", "CNCL"]
PROSPECT_MATCH = ["lastname", "firstname", "addressline1", "postalcode"]
DEMOGRAPHICS = ["agencyid", "creditrating", "networth", "marketingnameplate"]

CUSTOMER_TABLE = [
    "sk_customerid", "customerid", "taxid", "status", "lastname", "firstname", "middleinitial", "gender", "tier",
    "dob", "addressline1", "addressline2", "postalcode", "city", "stateprov", "country", "phone1", "phone2", "phone3",
    "email1", "email2", "nationaltaxratedesc", "nationaltaxrate", "localtaxratedesc", "localtaxrate", *DEMOGRAPHICS,
    "iscurrent", "batchid", "effectivedate", "enddate",
]
ACCOUNT_TABLE = [
    "sk_accountid", "accountid", "sk_brokerid", "sk_customerid", "accountdesc", "taxstatus", "status", "iscurrent",
    "batchid", "effectivedate", "enddate",
]
TRADE_TABLE = [
    "tradeid", "sk_brokerid", "sk_createdateid", "sk_createtimeid", "sk_closedateid", "sk_closetimeid", "status",
    "type", "cashflag", "sk_securityid", "sk_companyid", "quantity", "bidprice", "sk_customerid", "sk_accountid",
    "executedby", "tradeprice", "fee", "commission", "tax", "batchid",
]


def build_dim_broker(hr: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Employees with the broker job code, valid since the first calendar day."""
    return hr.filter(F.trim("employeejobcode") == BROKER_JOB).select(
        F.col("employeeid").alias("sk_brokerid"),
        F.col("employeeid").alias("brokerid"),
        "managerid",
        F.col("employeefirstname").alias("firstname"),
        F.col("employeelastname").alias("lastname"),
        F.col("employeemi").alias("middleinitial"),
        F.col("employeebranch").alias("branch"),
        F.col("employeeoffice").alias("office"),
        F.col("employeephone").alias("phone"),
        F.lit(True).alias("iscurrent"),
        F.lit(1).alias("batchid"),
        dim_date.select(F.min(F.to_date("datevalue"))).scalar().alias("effectivedate"),
        X.open_end().alias("enddate"),
    )


def build_dim_company(finwire: DataFrame, industry: DataFrame) -> DataFrame:
    rows = parse_cmp(finwire).withColumn("companyid", F.col("cik").try_cast("bigint"))
    known = rows.join(industry.select("in_id", F.col("in_name").alias("industry")), F.col("industryid") == F.col("in_id"))
    dated = close_open_versions(
        known.withColumnRenamed("recdate", "effectivedate"), "companyid", ["companyname", "status"]
    ).filter(F.col("effectivedate") < F.col("enddate"))
    return dated.select(
        X.smart_key("effectivedate", "companyid").alias("sk_companyid"),
        "companyid",
        X.decode_status("status").alias("status"),
        F.col("companyname").alias("name"),
        "industry",
        X.rating("sprating").alias("sprating"),
        X.is_low_grade("sprating").alias("islowgrade"),
        "ceo",
        "addressline1",
        "addressline2",
        "postalcode",
        "city",
        "stateprov",
        "country",
        "description",
        "foundingdate",
        "iscurrent",
        F.lit(1).alias("batchid"),
        "effectivedate",
        "enddate",
    )


def build_dim_security(finwire: DataFrame, dim_company: DataFrame) -> DataFrame:
    """Security versions cut at the versions of their company, referred to by name or number."""
    rows = parse_sec(finwire).withColumnRenamed("recdate", "effectivedate")
    versions = close_open_versions(rows, "symbol", ["conameorcik", "name", "status"]).withColumns(
        {"status": X.decode_status("status"), "conameorcik": X.norm_company_ref("conameorcik")}
    )
    companies = dim_company.select(
        "sk_companyid", F.col("name").alias("companyname"), "companyid", "effectivedate", "enddate"
    )
    pieces = union_key_join(
        versions, companies, "conameorcik", ["companyname", "companyid"], ["sk_companyid"], overlap=True
    )
    return pieces.select(
        X.stable_key("symbol", "effectivedate").alias("sk_securityid"),
        "symbol",
        "issue",
        "status",
        "name",
        "exchangeid",
        "sk_companyid",
        "sharesoutstanding",
        "firsttrade",
        "firsttradeonexchange",
        "dividend",
        "iscurrent",
        F.lit(1).alias("batchid"),
        "effectivedate",
        "enddate",
    )


def build_financial(finwire: DataFrame, dim_company: DataFrame) -> DataFrame:
    """Quarterly results of the company version valid at the record date."""
    rows = parse_fin(finwire)
    by_number = F.col("rectype") == "FIN_COMPANYID"
    ref = F.when(by_number, F.concat(F.lit("number "), X.norm_company_ref("conameorcik"))).otherwise(
        F.concat(F.lit("name "), F.col("conameorcik"))
    )
    companies = dim_company.select(
        "sk_companyid",
        F.concat(F.lit("number "), F.col("companyid").cast("string")).alias("number_ref"),
        F.concat(F.lit("name "), F.col("name")).alias("name_ref"),
        "effectivedate",
        "enddate",
    )
    joined = union_key_join(
        rows.withColumn("ref", ref), companies, "ref", ["number_ref", "name_ref"], ["sk_companyid"], at="recdate"
    )
    return joined.select("sk_companyid", *[c for c in joined.columns if c.startswith("fi_")])


def customer_history(mgmt: DataFrame, changes: DataFrame | None, batch_date: DataFrame) -> DataFrame:
    """Validity intervals of customers with every missing value carried forward."""
    rows = mgmt.filter(F.col("actiontype").isin("NEW", "INACT", "UPDCUST")).select(
        *CUSTOMER_COLS, F.lit(1).alias("batchid"), "update_ts"
    )
    if changes is not None:
        dated = changes.join(batch_date, "batchid").withColumn("update_ts", F.col("batchdate").cast("timestamp"))
        rows = rows.unionByName(dated.select(*rows.columns))
    hot = hot_window_keys(rows, ["customerid"])
    filled = forward_fill(rows, "customerid", ["update_ts", "batchid"], CUSTOMER_FILL, hot)
    return scd2_history(filled, "customerid", "update_ts", "batchid", hot=hot).drop("update_ts")


def one_prospect_per_address(prospects: DataFrame) -> DataFrame:
    """Of several prospects with one name and address the smallest agency id counts."""
    keys = {f"_k{i}": X.match_key(c) for i, c in enumerate(PROSPECT_MATCH)}
    keyed = prospects.select("*", *[k.alias(n) for n, k in keys.items()], X.match_key("addressline2", True).alias("_k"))
    return top1(keyed, [*keys, "_k"], ["agencyid"], descending=False).drop(*keys, "_k")


def with_tax_rates(customers: DataFrame, tax_rate: DataFrame) -> DataFrame:
    """National and local tax names and rates; a customer with an unknown code stays."""

    def rates(prefix: str, key: str) -> DataFrame:
        return tax_rate.select(
            F.col("tx_id").alias(key),
            F.col("tx_name").alias(f"{prefix}taxratedesc"),
            F.col("tx_rate").alias(f"{prefix}taxrate"),
        )

    return customers.join(rates("local", "lcl_tx_id"), "lcl_tx_id", "left").join(
        rates("national", "nat_tx_id"), "nat_tx_id", "left"
    )


def build_dim_customer(history: DataFrame, tax_rate: DataFrame, prospects: DataFrame) -> DataFrame:
    """``prospects`` are the prospect records visible at the batch that is loaded."""
    taxed = with_tax_rates(history, tax_rate)
    matched = name_match_join(
        taxed, one_prospect_per_address(prospects), PROSPECT_MATCH, ["addressline2"], right_cols=DEMOGRAPHICS
    )
    keyed = matched.withColumns(
        {"sk_customerid": X.smart_key("effectivedate", "customerid"), "gender": X.norm_gender("gender")}
    )
    return keyed.select(*CUSTOMER_TABLE)


def account_history(mgmt: DataFrame, changes: DataFrame | None, batch_date: DataFrame) -> DataFrame:
    rows = mgmt.filter(~F.col("actiontype").isin("UPDCUST", "INACT")).select(
        *ACCOUNT_COLS, F.lit(1).alias("batchid"), "update_ts"
    )
    if changes is not None:
        dated = changes.join(batch_date, "batchid").withColumn("update_ts", F.col("batchdate").cast("timestamp"))
        rows = rows.unionByName(dated.select(*rows.columns))
    hot = hot_window_keys(rows, ["accountid"])
    filled = forward_fill(rows, "accountid", ["update_ts", "batchid"], ACCOUNT_FILL, hot)
    return scd2_history(filled, "accountid", "update_ts", "batchid", hot=hot).drop("update_ts")


def build_dim_account(history: DataFrame, dim_customer: DataFrame, dim_broker: DataFrame) -> DataFrame:
    """Account versions cut at the versions of their customer."""
    pieces = interval_join(history, dim_customer, "customerid", "left", ["sk_customerid"])
    brokers = dim_broker.select("brokerid", "sk_brokerid")
    keyed = pieces.join(brokers, "brokerid").withColumn("sk_accountid", X.smart_key("effectivedate", "accountid"))
    return keyed.select(*ACCOUNT_TABLE)


def trade_attributes() -> list[str]:
    return [
        "t_tt_id", "cashflag", "t_s_symb", "quantity", "bidprice", "t_ca_id", "executedby", "tradeprice", "fee",
        "commission", "tax",
    ]


def trades_final(trades: DataFrame, history: DataFrame) -> DataFrame:
    """One row per trade: creation, current status, closing time and latest attributes.

    ``trades`` holds the rows of batch 1 and the change rows of later batches
    (``cdc_flag``, ``batchid``). Trades, status history and changes are stacked and
    grouped once, so the trade key is shuffled a single time.
    """
    attrs = F.struct(*trade_attributes())
    first = F.col("batchid") == 1
    rows = trades.select(
        "tradeid",
        F.when(~first, F.col("t_dts")).alias("ts"),
        F.when(~first, F.col("status")).alias("status"),
        F.when(first, F.lit("B")).otherwise(F.col("cdc_flag")).alias("kind"),
        F.struct("batchid", F.col("t_dts").alias("at")).alias("rank"),
        attrs.alias("attrs"),
        "batchid",
    )
    no_attrs = F.lit(None).cast(rows.schema["attrs"].dataType)
    no_rank = F.lit(None).cast(rows.schema["rank"].dataType)
    past = history.select(
        "tradeid",
        F.col("th_dts").alias("ts"),
        "status",
        F.lit("H").alias("kind"),
        no_rank.alias("rank"),
        no_attrs.alias("attrs"),
        F.lit(1).alias("batchid"),
    )
    kind = F.col("kind")
    grouped = rows.unionByName(past).groupBy("tradeid").agg(
        F.min("ts").alias("create_ts"),
        F.max_by(F.struct("ts", "status"), F.struct("ts", "status")).alias("last"),
        F.max_by("attrs", "rank").alias("attrs"),
        F.max(F.when(kind != "H", F.col("batchid"))).alias("batchid"),
        F.bool_or(kind == "B").alias("based"),
        F.bool_or(kind == "I").alias("inserted"),
    )
    known = grouped.filter((F.col("based") & F.col("create_ts").isNotNull()) | F.col("inserted"))
    closed = F.col("last.status").isin(CLOSED_TRADE)
    return known.select(
        "tradeid",
        "create_ts",
        F.when(closed, F.col("last.ts")).alias("close_ts"),
        F.col("last.status").alias("status"),
        "attrs.*",
        "batchid",
    )


def trade_columns(trades: DataFrame) -> DataFrame:
    """Decode codes and derive date and time keys."""
    return trades.withColumns(
        {
            "sk_createdateid": X.date_key("create_ts"),
            "sk_createtimeid": X.time_key("create_ts"),
            "sk_closedateid": X.date_key("close_ts"),
            "sk_closetimeid": X.time_key("close_ts"),
            "status": X.decode_status("status"),
            "type": X.decode_trade_type("t_tt_id"),
            "cashflag": F.coalesce(F.col("cashflag") == 1, F.lit(False)),
        }
    )


SECURITY_REFS = ["sk_securityid", "sk_companyid"]
ACCOUNT_REFS = ["sk_brokerid", "sk_customerid", "sk_accountid"]


def build_dim_trade(final: DataFrame, dim_security: DataFrame, dim_account: DataFrame) -> DataFrame:
    """Trades with the security and account versions valid on the day they were created."""
    secured = pit_join(final, dim_security, [("t_s_symb", "symbol")], "create_ts", dim_cols=SECURITY_REFS)
    joined = pit_join(secured, dim_account, [("t_ca_id", "accountid")], "create_ts", dim_cols=ACCOUNT_REFS)
    return trade_columns(joined).select(*TRADE_TABLE)
