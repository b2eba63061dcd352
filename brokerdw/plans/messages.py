"""Rows of the message log: validation reports, visibility reports, alerts, phase records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brokerdw.functions import exprs as X
from brokerdw.operators.grouping import top1
from brokerdw.operators.hotkeys import looked_up, row_count
from brokerdw.sources.scans import parse_cmp, union_all

Tables = Mapping[str, DataFrame]

# Tables counted by the validation report. Fixed values of the report.
COUNTED = [
    "DimAccount", "DimBroker", "DimCompany", "DimCustomer", "DimDate", "DimSecurity", "DimTime", "DimTrade",
    "FactCashBalances", "FactHoldings", "FactMarketHistory", "FactWatches", "Financial", "Industry", "Prospect",
    "StatusType", "TaxRate", "TradeType",
]
# Dimensions each fact is joined to for its joined row count: (dimension, fact key, dimension key).
JOINED = {
    "FactCashBalances": [
        ("DimAccount", "sk_accountid", "sk_accountid"),
        ("DimCustomer", "sk_customerid", "sk_customerid"),
        ("DimBroker", "sk_brokerid", "sk_brokerid"),
        ("DimDate", "sk_dateid", "sk_dateid"),
    ],
    "FactHoldings": [
        ("DimAccount", "sk_accountid", "sk_accountid"),
        ("DimCustomer", "sk_customerid", "sk_customerid"),
        ("DimBroker", "sk_brokerid", "sk_brokerid"),
        ("DimDate", "sk_dateid", "sk_dateid"),
        ("DimTime", "sk_timeid", "sk_timeid"),
        ("DimCompany", "sk_companyid", "sk_companyid"),
        ("DimSecurity", "sk_securityid", "sk_securityid"),
    ],
    "FactMarketHistory": [
        ("DimDate", "sk_dateid", "sk_dateid"),
        ("DimCompany", "sk_companyid", "sk_companyid"),
        ("DimSecurity", "sk_securityid", "sk_securityid"),
    ],
    "FactWatches": [
        ("DimCustomer", "sk_customerid", "sk_customerid"),
        ("DimDate", "sk_dateid_dateplaced", "sk_dateid"),
        ("DimSecurity", "sk_securityid", "sk_securityid"),
    ],
}


def _count(df: DataFrame, source: str, text: str, condition: Column | None = None) -> DataFrame:
    number = F.count(F.lit(1)) if condition is None else F.count_if(condition)
    return df.agg(number.alias("n")).select(
        F.lit(source).alias("messagesource"), F.lit(text).alias("messagetext"), F.col("n").cast("string").alias("messagedata")
    )


def _joined(tables: Tables, fact: str) -> DataFrame:
    """A fact joined to its dimensions; the broker hangs on the account."""
    out = tables[fact.lower()]
    for dim, fact_key, dim_key in JOINED[fact]:
        cols = [dim_key, "sk_brokerid"] if dim == "DimAccount" else [dim_key]
        right = tables[dim.lower()].select(*[F.col(c).alias(f"{dim}_{c}") for c in cols])
        right = looked_up(right, row_count(tables[dim.lower()]))
        left_key = "DimAccount_sk_brokerid" if dim == "DimBroker" else fact_key
        out = out.join(right, F.col(left_key) == F.col(f"{dim}_{dim_key}"))
    return out


def _stamped(rows: DataFrame, batch: Column | int, kind: str) -> DataFrame:
    number = F.lit(batch) if isinstance(batch, int) else batch
    return rows.select(
        F.current_timestamp().alias("messagedateandtime"),
        number.cast("int").alias("batchid"),
        "messagesource",
        "messagetext",
        F.lit(kind).alias("messagetype"),
        "messagedata",
    )


def row_counts(tables: Tables) -> DataFrame:
    return union_all([_count(tables[t.lower()], t, "Row count") for t in COUNTED])


def joined_count(tables: Tables, fact: str) -> DataFrame:
    return _count(_joined(tables, fact), fact, "Row count joined")


def joined_counts(tables: Tables) -> DataFrame:
    return union_all([joined_count(tables, fact) for fact in JOINED])


def validation_parts(tables: Tables, batch: int) -> list[DataFrame]:
    """The validation report in parts that can be stored one by one: all table counts, then each fact's joins."""
    inactive = F.col("iscurrent") & (F.col("status") == "Inactive")
    rows = [
        row_counts(tables),
        *[joined_count(tables, fact) for fact in JOINED],
        _count(tables["dimcustomer"], "DimCustomer", "Inactive customers", inactive),
        _count(tables["factwatches"], "FactWatches", "Inactive watches", F.col("sk_dateid_dateremoved").isNotNull()),
    ]
    return [_stamped(part, batch, "Validation") for part in rows]


def validation_report(tables: Tables, batch: int) -> DataFrame:
    """24 rows: table counts, joined fact counts, inactive customers, inactive watches."""
    return union_all(validation_parts(tables, batch))


def visibility(tables: Tables, kind: int, batch: int) -> DataFrame:
    """Counts taken while a load runs: kind 1 with joined counts, kind 2 without."""
    rows = row_counts(tables)
    return _stamped(rows.unionByName(joined_counts(tables)) if kind == 1 else rows, batch, f"Visibility_{kind}")


def phase_complete(spark: SparkSession, batch: int) -> DataFrame:
    """The record that a batch has been loaded."""
    row = spark.range(1).select(
        F.lit("Phase Complete Record").alias("messagesource"),
        F.lit("Batch Complete").alias("messagetext"),
        F.lit(None).cast("string").alias("messagedata"),
    )
    return _stamped(row, batch, "PCR")


def _alert(rows: DataFrame, source: str, text: str, data: Column, batch: Column | None = None) -> DataFrame:
    return rows.select(
        (F.col("batchid") if batch is None else batch).cast("int").alias("batchid"),
        F.lit(source).alias("messagesource"),
        F.lit(text).alias("messagetext"),
        data.alias("messagedata"),
    )


def alert_rows(tables: Tables, batch_date: DataFrame, finwire: DataFrame) -> DataFrame:
    """Violations of the six business rules, each reported once."""
    text = lambda c: F.col(c).cast("string")
    customers, trades = tables["dimcustomer"], tables["dimtrade"]

    bad_tier = customers.filter(F.col("tier").isNull() | ~F.col("tier").isin(1, 2, 3))
    last = top1(bad_tier.select("customerid", "batchid", "tier", "enddate"), ["customerid", "batchid"], ["enddate"])
    tier = _alert(
        last,
        "DimCustomer",
        "Invalid customer tier",
        F.concat(F.lit("C_ID = "), text("customerid"), F.lit(", C_TIER = "), F.coalesce(text("tier"), F.lit("null"))),
    )

    born = customers.select("customerid", "dob", "batchid").join(batch_date, "batchid")
    too_old_or_unborn = (X.full_years("dob", "batchdate") >= 100) | (F.col("dob") > F.col("batchdate"))
    age = _alert(
        born.filter(too_old_or_unborn),
        "DimCustomer",
        "DOB out of range",
        F.concat(F.lit("C_ID = "), text("customerid"), F.lit(", C_DOB = "), text("dob")),
    ).distinct()

    worth = F.col("tradeprice") * F.col("quantity")

    def dear(column: str, message: str, label: str) -> DataFrame:
        data = F.concat(F.lit("T_ID = "), text("tradeid"), F.lit(f", {label} = "), text(column))
        return _alert(trades.filter(F.col(column) > worth), "DimTrade", message, data).distinct()

    symbols = looked_up(tables["dimsecurity"].select("sk_securityid", "symbol"), row_count(tables["dimsecurity"]))
    no_earnings = tables["factmarkethistory"].filter(F.col("peratio").isNull()).select("batchid", "sk_securityid")
    # Distinct keys first: one row per security and batch is joined, not one per quote.
    earnings = _alert(
        no_earnings.distinct().join(symbols, "sk_securityid"),
        "FactMarketHistory",
        "No earnings for company",
        F.concat(F.lit("DM_S_SYMB = "), F.col("symbol")),
    ).distinct()

    unknown = parse_cmp(finwire).filter(~F.col("sprating").isin(X.RATINGS))
    rating = _alert(
        unknown,
        "DimCompany",
        "Invalid SPRating",
        F.concat(F.lit("CO_ID = "), F.col("cik"), F.lit(", CO_SP_RATE = "), F.col("sprating")),
        F.lit(1),
    ).distinct()

    return union_all(
        [
            tier,
            age,
            dear("commission", "Invalid trade commission", "T_COMM"),
            dear("fee", "Invalid trade fee", "T_CHRG"),
            earnings,
            rating,
        ]
    )


def alerts(tables: Tables, batch_date: DataFrame, finwire: DataFrame) -> DataFrame:
    return _stamped(alert_rows(tables, batch_date, finwire), F.col("batchid"), "Alert")


def expectations() -> dict[str, dict[str, Column]]:
    """Rules checked on write, per table: rows that fail are counted and kept."""
    worth = F.col("tradeprice") * F.col("quantity")
    return {
        "dimcustomer": {"invalid_customer_tier": F.col("tier").isin(1, 2, 3) & F.col("tier").isNotNull()},
        "factmarkethistory": {"no_earnings_for_company": F.col("peratio").isNotNull()},
        "dimtrade": {
            "invalid_trade_commission": F.col("commission").isNull() | (F.col("commission") <= worth),
            "invalid_trade_fee": F.col("fee").isNull() | (F.col("fee") <= worth),
        },
    }
