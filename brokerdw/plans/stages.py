"""Staged relations: raw rows conformed once, used by several products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brokerdw.functions import exprs as X
from brokerdw.operators.grouping import first_last_seen
from brokerdw.operators.hotkeys import NO_HOT, looked_up, row_count
from brokerdw.operators.rolling import rolling_extremes, running_balance, trailing_sum

# Customer columns in warehouse order; all but the keys and status are filled forward.
CUSTOMER_FILL = [
    "taxid", "lastname", "firstname", "middleinitial", "gender", "tier", "dob", "addressline1", "addressline2",
    "postalcode", "city", "stateprov", "country", "phone1", "phone2", "phone3", "email1", "email2", "lcl_tx_id",
    "nat_tx_id",
]
CUSTOMER_COLS = ["customerid", "status", *CUSTOMER_FILL]
ACCOUNT_FILL = ["accountdesc", "taxstatus", "brokerid", "status"]
ACCOUNT_COLS = ["accountid", "customerid", *ACCOUNT_FILL]


def customer_mgmt(actions: DataFrame) -> DataFrame:
    """Customer and account actions of the XML extract as flat rows."""
    text = lambda path: X.blank_to_null(F.col(path))

    def phone(n: int):
        part = f"Customer.ContactInfo.C_PHONE_{n}"
        return X.format_phone(f"{part}.C_CTRY_CODE", f"{part}.C_AREA_CODE", f"{part}.C_LOCAL", f"{part}.C_EXT")

    number = lambda path, kind: text(path).try_cast(kind)
    return actions.select(
        number("Customer._C_ID", "bigint").alias("customerid"),
        number("Customer.Account._CA_ID", "bigint").alias("accountid"),
        number("Customer.Account.CA_B_ID", "bigint").alias("brokerid"),
        text("Customer._C_TAX_ID").alias("taxid"),
        text("Customer.Account.CA_NAME").alias("accountdesc"),
        number("Customer.Account._CA_TAX_ST", "tinyint").alias("taxstatus"),
        X.decode_action("_ActionType").alias("status"),
        text("Customer.Name.C_L_NAME").alias("lastname"),
        text("Customer.Name.C_F_NAME").alias("firstname"),
        text("Customer.Name.C_M_NAME").alias("middleinitial"),
        F.upper(text("Customer._C_GNDR")).alias("gender"),
        number("Customer._C_TIER", "tinyint").alias("tier"),
        number("Customer._C_DOB", "date").alias("dob"),
        text("Customer.Address.C_ADLINE1").alias("addressline1"),
        text("Customer.Address.C_ADLINE2").alias("addressline2"),
        text("Customer.Address.C_ZIPCODE").alias("postalcode"),
        text("Customer.Address.C_CITY").alias("city"),
        text("Customer.Address.C_STATE_PROV").alias("stateprov"),
        text("Customer.Address.C_CTRY").alias("country"),
        *[phone(n).alias(f"phone{n}") for n in (1, 2, 3)],
        text("Customer.ContactInfo.C_PRIM_EMAIL").alias("email1"),
        text("Customer.ContactInfo.C_ALT_EMAIL").alias("email2"),
        text("Customer.TaxInfo.C_LCL_TX_ID").alias("lcl_tx_id"),
        text("Customer.TaxInfo.C_NAT_TX_ID").alias("nat_tx_id"),
        F.col("_ActionTS").try_cast("timestamp").alias("update_ts"),
        F.col("_ActionType").alias("actiontype"),
    )


def customer_changes(raw: DataFrame) -> DataFrame:
    """Customer change records of later batches in the columns of :func:`customer_mgmt`."""
    plain = {"tier", "dob", "phone1", "phone2", "phone3"}
    out = []
    for c in CUSTOMER_FILL:
        if c.startswith("phone"):
            n = c[-1]
            out.append(X.format_phone(f"c_ctry_{n}", f"c_area_{n}", f"c_local_{n}", f"c_ext_{n}").alias(c))
        elif c in plain:
            out.append(F.col(c))
        elif c == "gender":
            out.append(F.upper(X.blank_to_null(c)).alias(c))
        else:
            out.append(X.blank_to_null(c).alias(c))
    return raw.select("customerid", X.decode_status("status").alias("status"), *out, "batchid")


def account_changes(raw: DataFrame) -> DataFrame:
    """Account change records of later batches."""
    return raw.select(
        "accountid",
        "customerid",
        X.blank_to_null("accountdesc").alias("accountdesc"),
        "taxstatus",
        "brokerid",
        X.decode_status("status").alias("status"),
        "batchid",
    )


def prospect_stage(snapshots: DataFrame) -> DataFrame:
    """Distinct prospect records with marketing tags and the batches that show them."""
    # Grouped first: the tags depend on the record only.
    return with_tags(first_last_seen(snapshots))


def with_tags(records: DataFrame) -> DataFrame:
    tags = X.nameplate(
        "networth", "income", "numberchildren", "numbercreditcards", "age", "numbercars", "creditrating"
    )
    return records.withColumn("marketingnameplate", tags)


def cash_stage(cash: DataFrame) -> DataFrame:
    """Balance per account, day and batch over all transactions of all batches."""
    return running_balance(cash, "accountid", "ct_dts", "ct_amt", ["batchid"])


def daily_market_stage(market: DataFrame, preceding: int = 364, hot=None) -> DataFrame:
    """Daily quotes with the extremes of the last year of quotes of the symbol."""
    found = rolling_extremes(market, "dm_s_symb", ["dm_date", "batchid"], "dm_low", "dm_high", preceding, hot)
    return found.select(
        *market.columns,
        F.col("high_value").alias("fiftytwoweekhigh"),
        X.date_key("high_date").alias("sk_fiftytwoweekhighdate"),
        F.col("low_value").alias("fiftytwoweeklow"),
        X.date_key("low_date").alias("sk_fiftytwoweeklowdate"),
    )


def company_eps_stage(financial: DataFrame, dim_company: DataFrame) -> DataFrame:
    """Earnings per share of the four quarters before each quarter, over all versions of a company.

    A company has one row per quarter, so its window is small by nature.
    """
    company = looked_up(dim_company.select("sk_companyid", "companyid"), row_count(dim_company))
    numbered = financial.join(company, "sk_companyid")
    summed = trailing_sum(
        numbered.select("companyid", "sk_companyid", "fi_qtr_start_date", "fi_basic_eps"),
        "companyid",
        ["fi_qtr_start_date", "sk_companyid"],
        "fi_basic_eps",
        out="sum_fi_basic_eps",
        hot=NO_HOT,
    )
    return summed.select("sk_companyid", "fi_qtr_start_date", "sum_fi_basic_eps")
