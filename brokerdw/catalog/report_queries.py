"""Message log and audit (DQ-1..4, AUD-1..20) over the derived warehouse."""

from pyspark.sql import functions as F

from brokerdw.catalog import derived as d
from brokerdw.catalog.registry import query, table
from brokerdw.operators import checks
from brokerdw.plans import audit, messages
from brokerdw.plans import dimensions as dims
from brokerdw.sources.scans import union_all

MARKET = "dimcompany dimsecurity financial eps market factmarket"


@query(
    "alerts",
    d.with_ctes(
        f"{d.TRADE} financial eps market factmarket",
        """
    SELECT batchid, 'DimCustomer' AS messagesource, 'Invalid customer tier' AS messagetext,
           'C_ID = ' || customerid || ', C_TIER = ' || coalesce(CAST(tier AS VARCHAR), 'null') AS messagedata
    FROM (SELECT * FROM dimcustomer WHERE tier IS NULL OR tier NOT IN (1, 2, 3)
          QUALIFY row_number() OVER (PARTITION BY customerid, batchid ORDER BY enddate DESC) = 1)
    UNION ALL
    SELECT DISTINCT c.batchid, 'DimCustomer', 'DOB out of range', 'C_ID = ' || customerid || ', C_DOB = ' || dob
    FROM dimcustomer c JOIN batchdate b ON c.batchid = b.batchid
    WHERE date_sub('year', dob, b.batchdate) >= 100 OR dob > b.batchdate
    UNION ALL
    SELECT DISTINCT batchid, 'DimTrade', 'Invalid trade commission', 'T_ID = ' || tradeid || ', T_COMM = ' || commission
    FROM dimtrade WHERE commission > tradeprice * quantity
    UNION ALL
    SELECT DISTINCT batchid, 'DimTrade', 'Invalid trade fee', 'T_ID = ' || tradeid || ', T_CHRG = ' || fee
    FROM dimtrade WHERE fee > tradeprice * quantity
    UNION ALL
    SELECT DISTINCT batchid, 'FactMarketHistory', 'No earnings for company', 'DM_S_SYMB = ' || symbol
    FROM factmarket WHERE peratio IS NULL
    UNION ALL
    SELECT DISTINCT 1, 'DimCompany', 'Invalid SPRating',
           'CO_ID = ' || lpad(CAST(l_suppkey AS VARCHAR), 10, '0') || ', CO_SP_RATE = ' ||
           CASE (l_suppkey + month(d)) % 24 WHEN 22 THEN 'ZZZ' ELSE '' END
    FROM (SELECT l_suppkey, min(l_shipdate) AS d FROM lineitem GROUP BY l_suppkey, date_trunc('quarter', l_shipdate))
    WHERE (l_suppkey + month(d)) % 24 IN (22, 23)""",
    ),
)
def alerts(spark, sf):
    w = d.warehouse(spark, sf)
    return messages.alert_rows(w, d.batch_date(spark), w["finwire"])


def _count(source: str, body: str, label: str = "Row count") -> str:
    return f"SELECT '{source}' AS messagesource, '{label}' AS messagetext, CAST(count(*) AS VARCHAR) AS messagedata {body}"


VALIDATION = " UNION ALL ".join(
    [
        _count("DimAccount", "FROM dimaccount"),
        _count("DimBroker", "FROM dimbroker"),
        _count("DimCompany", "FROM dimcompany"),
        _count("DimCustomer", "FROM dimcustomer"),
        _count("DimDate", "FROM dimdate"),
        _count("DimSecurity", "FROM dimsecurity"),
        _count("DimTime", "FROM (SELECT DISTINCT sk_closetimeid FROM dimtrade WHERE sk_closetimeid IS NOT NULL)"),
        _count("DimTrade", "FROM dimtrade"),
        _count("FactCashBalances", "FROM factcash"),
        _count("FactHoldings", "FROM factholding"),
        _count("FactMarketHistory", "FROM factmarket"),
        _count("FactWatches", "FROM factwatch"),
        _count("Financial", "FROM financial"),
        _count("Industry", "FROM nation"),
        _count("Prospect", "FROM prospect WHERE recordbatchid >= 3"),
        _count("StatusType", "FROM (SELECT DISTINCT o_orderstatus FROM orders)"),
        _count("TaxRate", "FROM tax"),
        _count("TradeType", "FROM (SELECT DISTINCT o_orderpriority FROM orders)"),
        _count("FactCashBalances", "FROM factcash f JOIN dimdate d ON f.sk_dateid = d.sk_dateid", "Row count joined"),
        _count("FactHoldings", "FROM factholding f JOIN dimdate d ON f.sk_closedateid = d.sk_dateid", "Row count joined"),
        _count("FactMarketHistory", "FROM factmarket f JOIN dimdate d ON f.sk_dateid = d.sk_dateid", "Row count joined"),
        _count("FactWatches", "FROM factwatch f JOIN dimdate d ON f.sk_dateid_dateplaced = d.sk_dateid", "Row count joined"),
        _count("DimCustomer", "FROM dimcustomer WHERE iscurrent AND status = 'Inactive'", "Inactive customers"),
        _count("FactWatches", "FROM factwatch WHERE sk_dateid_dateremoved IS NOT NULL", "Inactive watches"),
    ]
)
ALL = f"{d.TRADE} financial eps market factmarket cash factcash watch factwatch factholding dimdate"


@query("validation_report", d.with_ctes(ALL, " " + VALIDATION))
def validation_report(spark, sf):
    """24 rows: table counts, joined counts, inactive customers and watches (DQ-2)."""
    report = messages.validation_report(d.warehouse(spark, sf), 1)
    return report.select("messagesource", "messagetext", "messagedata")


@query(
    "visibility_report",
    d.with_ctes(
        ALL,
        " SELECT messagesource, messagetext, messagedata, k AS messagetype FROM ("
        + VALIDATION
        + ") v CROSS JOIN (VALUES ('Visibility_1'), ('Visibility_2'), ('PCR')) t(k) "
        "WHERE (messagetext = 'Row count' AND k <> 'PCR') OR (messagetext = 'Row count joined' AND k = 'Visibility_1') "
        "UNION ALL SELECT 'Phase Complete Record', 'Batch Complete', NULL, 'PCR'",
    ),
)
def visibility_report(spark, sf):
    """Counts taken while a load runs, with and without joins, and the phase record (DQ-3, DQ-4)."""
    w = d.warehouse(spark, sf)
    rows = [messages.visibility(w, 1, 1), messages.visibility(w, 2, 1), messages.phase_complete(spark, 1)]
    return union_all(rows).select("messagesource", "messagetext", "messagedata", "messagetype")


def _history_sql(name: str, table_name: str, key: str, sk: str) -> str:
    value = lambda m, expr, tail="": (
        f"SELECT '{name}.{m}' AS measure, CAST(NULL AS INT) AS batchid, CAST({expr} AS BIGINT) AS value FROM {table_name} a {tail}"
    )
    per = lambda m, expr: (
        f"SELECT '{name}.{m}', batchid, CAST({expr} AS BIGINT) FROM {table_name} GROUP BY batchid"
    )
    end = "DATE '9999-12-31'"
    since = "date_diff('day', DATE '1970-01-01', "
    return " UNION ALL ".join(
        [
            per("rows", "count(*)"),
            per("open", f"count(*) FILTER (WHERE enddate = {end})"),
            per("empty", "count(*) FILTER (WHERE effectivedate = enddate)"),
            per("flagged", f"count(*) FILTER (WHERE (enddate = {end}) = iscurrent)"),
            per("first_day", f"{since} min(effectivedate))"),
            per("last_day", f"{since} max(effectivedate))"),
            value("aligned", "count(*)", f"JOIN {table_name} b ON a.{key} = b.{key} AND a.enddate = b.effectivedate"),
            value(
                "overlap",
                "count(*)",
                f"JOIN {table_name} b ON a.{key} = b.{key} AND a.{sk} <> b.{sk} "
                "AND a.effectivedate >= b.effectivedate AND a.effectivedate < b.enddate",
            ),
            value("surrogates", f"count(DISTINCT {sk})"),
            value("keys", f"count(DISTINCT {key})"),
        ]
    )


@query(
    "audit_history",
    d.with_ctes(
        d.ACCOUNT,
        " SELECT measure, CAST(batchid AS INT) AS batchid, value FROM ("
        + _history_sql("DimCustomer", "dimcustomer", "customerid", "sk_customerid")
        + " UNION ALL "
        + _history_sql("DimAccount", "dimaccount", "accountid", "sk_accountid")
        + ") t(measure, batchid, value)",
    ),
)
def audit_history(spark, sf):
    """Measures of the type 2 checks: chains, overlaps, open rows, keys, batch windows (AUD-3..10)."""
    w = d.warehouse(spark, sf)
    return union_all(audit._history_measures(w, "DimCustomer") + audit._history_measures(w, "DimAccount"))


def _valid(name: str, fact: str, dim: str, key: str, day: str) -> str:
    return (
        f"SELECT '{name}' AS measure, count(*) AS value FROM {fact} f JOIN dimdate x ON x.sk_dateid = f.{day} "
        f"JOIN {dim} c ON f.{key} = c.{key} AND c.effectivedate <= x.datevalue AND x.datevalue <= c.enddate"
    )


@query(
    "audit_references",
    d.with_ctes(
        f"{ALL} ",
        " "
        + " UNION ALL ".join(
            [
                _valid("DimTrade.company", "dimtrade", "dimcompany", "sk_companyid", "sk_createdateid"),
                _valid("DimTrade.security", "dimtrade", "dimsecurity", "sk_securityid", "sk_createdateid"),
                _valid("DimTrade.customer", "dimtrade", "dimcustomer", "sk_customerid", "sk_createdateid"),
                _valid("DimTrade.account", "dimtrade", "dimaccount", "sk_accountid", "sk_createdateid"),
                _valid("FactWatches.customer", "factwatch", "dimcustomer", "sk_customerid", "sk_dateid_dateplaced"),
                _valid("FactWatches.security", "factwatch", "dimsecurity", "sk_securityid", "sk_dateid_dateplaced"),
                _valid("FactCashBalances.customer", "factcash", "dimcustomer", "sk_customerid", "sk_dateid"),
                _valid("FactCashBalances.account", "factcash", "dimaccount", "sk_accountid", "sk_dateid"),
                "SELECT 'DimAccount.customer', count(*) FROM dimaccount a JOIN dimcustomer c "
                "ON a.sk_customerid = c.sk_customerid AND c.effectivedate <= a.effectivedate AND a.enddate <= c.enddate",
            ]
        ),
    ),
)
def audit_references(spark, sf):
    """Rows whose references exist and are valid on the row's day (AUD-13, AUD-14)."""
    trade = [*dims.SECURITY_REFS, "sk_customerid", "sk_accountid", "sk_createdateid"]
    keys = {"dimcustomer": d.CUSTOMER_KEYS, "dimaccount": d.ACCOUNT_KEYS, "dimsecurity": d.SECURITY_KEYS, "dimtrade": trade}
    w = d.warehouse(spark, sf, keys)
    customer, account = ("DimCustomer", "sk_customerid"), ("DimAccount", "sk_accountid")
    company, security = ("DimCompany", "sk_companyid"), ("DimSecurity", "sk_securityid")
    parts = [
        audit._valid_refs(
            w,
            "DimTrade",
            {"company": company, "security": security, "customer": customer, "account": account},
            "sk_createdateid",
        ),
        audit._valid_refs(w, "FactWatches", {"customer": customer, "security": security}, "sk_dateid_dateplaced"),
        audit._valid_refs(w, "FactCashBalances", {"customer": customer, "account": account}, "sk_dateid"),
        audit._valid_refs(w, "DimAccount", {"customer": customer}, None),
    ]
    return union_all(parts).drop("batchid")


@query(
    "audit_values",
    d.with_ctes(
        f"{d.TRADE} ",
        """
    SELECT 'bad_status' AS measure, count(*) FILTER (WHERE status NOT IN ('Active', 'Inactive')) AS value FROM dimcustomer
    UNION ALL SELECT 'bad_gender', count(*) FILTER (WHERE gender NOT IN ('M', 'F')) FROM dimcustomer
    UNION ALL SELECT 'bad_address', count(*) FILTER (WHERE addressline1 NOT LIKE 'moved %'
                     AND addressline1 NOT LIKE 'late %' AND addressline1 <> '') FROM dimcustomer
    UNION ALL SELECT 'bad_rating', count(*) FILTER (WHERE sprating NOT IN ('AAA', 'BB+')) FROM dimcompany
    UNION ALL SELECT 'bad_type', count(*) FILTER (WHERE type NOT IN ('Market Buy', 'Limit Sell')) FROM dimtrade
    UNION ALL SELECT 'canceled', count(*) FILTER (WHERE status = 'Canceled') FROM dimtrade
    UNION ALL SELECT 'backward', count(*) FILTER (WHERE sk_closedateid < sk_createdateid) FROM dimtrade
    UNION ALL SELECT 'bad_plate', sum(
      (networth > 1000000 OR income > 200000)::INT * (NOT contains(shown, 'HighValue'))::INT
      + (children > 3 OR cards > 5)::INT * (NOT contains(shown, 'Expenses'))::INT
      + (age > 45)::INT * (NOT contains(shown, 'Boomer'))::INT
      + (income < 50000 OR creditrating < 600 OR networth < 100000)::INT * (NOT contains(shown, 'MoneyAlert'))::INT
      + (cars > 3 OR cards > 7)::INT * (NOT contains(shown, 'Spender'))::INT
      + (age < 25 AND networth > 1000000)::INT * (NOT contains(shown, 'Inherited'))::INT
      + (shown <> '' AND list_sort(list_distinct(list_transform(string_split(shown, '+'), lambda x: coalesce(list_position(tags, x), 0))))
         <> list_transform(string_split(shown, '+'), lambda x: coalesce(list_position(tags, x), -1)))::INT)
      FROM (SELECT *, ['HighValue', 'Expenses', 'Boomer', 'MoneyAlert', 'Spender', 'Inherited'] AS tags,
              CASE CAST(agencyid[2:] AS INT) % 10 WHEN 3 THEN replace(plate, 'Boomer', '') WHEN 4 THEN plate || '+Odd'
                   WHEN 5 THEN 'Spender+Expenses' ELSE plate END AS shown
            FROM (SELECT * REPLACE (CAST(income AS BIGINT) AS income) FROM prospect) WHERE recordbatchid >= 3)
    UNION ALL SELECT 'demographics', count(*) FROM dimcustomer c JOIN prospect p ON p.recordbatchid >= 3
      AND upper(c.firstname || c.lastname || c.addressline1 || c.postalcode)
        = upper(p.firstname || p.lastname || p.addressline1 || p.postalcode)
      AND coalesce(c.creditrating, 0) = coalesce(p.creditrating, 0) AND coalesce(c.networth, 0) = coalesce(p.networth, 0)
      AND coalesce(c.marketingnameplate, '') = coalesce(p.plate, '') WHERE c.iscurrent""",
    ),
)
def audit_values(spark, sf):
    """Domain, pattern, cross-column and demographic measures (AUD-11, 12, 16, 17); three in ten tag lists are made wrong."""
    person = [*dims.PROSPECT_MATCH, "addressline2", *dims.DEMOGRAPHICS, "status", "gender"]
    trade = ["type", "status", "sk_createdateid", "sk_closedateid"]
    keys = {"dimcustomer": [*d.CUSTOMER_KEYS, *person], "dimaccount": d.ACCOUNT_KEYS, "dimsecurity": d.SECURITY_KEYS, "dimtrade": trade}
    w = d.warehouse(spark, sf, keys)
    plate, last = F.col("marketingnameplate"), F.substring("agencyid", 2, 20).cast("int") % 10
    wrong = F.when(last == 3, F.replace(plate, F.lit("Boomer"), F.lit(""))).when(last == 4, F.concat(plate, F.lit("+Odd")))
    tagged = w["prospect"].withColumn("marketingnameplate", wrong.when(last == 5, "Spender+Expenses").otherwise(plate))
    parts = {
        "dimcustomer": {
            "bad_status": audit._not_in("status", ["Active", "Inactive"]),
            "bad_gender": audit._not_in("gender", ["M", "F"]),
            "bad_address": audit._not_like("addressline1", ["moved %", "late %"]),
        },
        "dimcompany": {"bad_rating": audit._not_in("sprating", ["AAA", "BB+"])},
        "dimtrade": {
            "bad_type": audit._not_in("type", ["Market Buy", "Limit Sell"]),
            "canceled": F.count_if(F.col("status") == "Canceled"),
            "backward": F.count_if(F.col("sk_closedateid") < F.col("sk_createdateid")),
        },
        "prospect": {"bad_plate": audit.nameplate_errors()},
    }
    found = [audit.measure(tagged if t == "prospect" else w[t], "x", values, by_batch=False) for t, values in parts.items()]
    found.append(audit._demographic_matches(w))
    return union_all(found).select(F.element_at(F.split("measure", "[.]"), 2).alias("measure"), "value")


@query(
    "audit_regression",
    """
    WITH m AS (SELECT event_type AS messagesource, CAST(ts AS DATE) AS t, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT 'visibility.' || messagesource AS measure, count(*) FILTER (WHERE later < n) AS value
    FROM (SELECT a.*, (SELECT min(b.n) FROM m b WHERE b.messagesource = a.messagesource AND b.t > a.t) AS later FROM m a)
    GROUP BY messagesource
    """,
)
def audit_regression(spark, sf):
    """Counts of a source that some later report undercuts (AUD-19, AUD-20)."""
    daily = table(spark, sf, "events").groupBy("event_type", F.to_date("ts").alias("t")).agg(F.count(F.lit(1)).alias("n"))
    log = daily.select(
        F.col("t").cast("timestamp").alias("messagedateandtime"),
        F.lit(1).alias("batchid"),
        F.col("event_type").alias("messagesource"),
        F.lit("Row count").alias("messagetext"),
        F.lit("Visibility_1").alias("messagetype"),
        F.col("n").cast("string").alias("messagedata"),
    )
    return audit.visibility_regressions(log).select("measure", "value")


@query("audit_report")
def audit_report(spark, sf):
    """All checks with verdicts; what is expected is counted in the records that the tables are built from (AUD-1..20)."""
    w = d.warehouse(spark, sf)
    dates = {r["batchid"]: r["batchdate"] for r in d.batch_date(spark).collect()}  # one row per batch
    log = [messages.alerts(w, d.batch_date(spark), w["finwire"])]
    for b in [0, *dates]:
        log += [*messages.validation_parts(d.as_of(w, b, dates.get(b)), b), messages.phase_complete(spark, b)]
    return audit.audit(w, d.stored_parts(log, "dimessages"), d.expected(w, dates))


def _rule(name: str, rule: str, passes: str) -> str:
    return (
        f"SELECT '{name}' AS name, '{rule}' AS rule, count(*) FILTER (WHERE {passes}) AS passed, "
        f"count(*) - count(*) FILTER (WHERE {passes}) AS failed FROM "
    )


@query(
    "expectations_products",
    d.with_ctes(
        f"{d.TRADE} financial eps market factmarket",
        " UNION ALL ".join(
            [
                _rule("dimcustomer", "invalid_customer_tier", "tier IN (1, 2, 3)") + "dimcustomer",
                _rule("factmarkethistory", "no_earnings_for_company", "peratio IS NOT NULL") + "factmarket",
                _rule("dimtrade", "invalid_trade_commission", "commission IS NULL OR commission <= tradeprice * quantity") + "dimtrade",
                _rule("dimtrade", "invalid_trade_fee", "fee IS NULL OR fee <= tradeprice * quantity") + "dimtrade",
            ]
        ),
    ),
)
def expectations_products(spark, sf):
    """The rules of the change pipeline on the products they belong to (DQ-7)."""
    w = d.warehouse(spark, sf)
    found = [
        checks.expect(w[name], rules).select(F.lit(name).alias("name"), "*") for name, rules in messages.expectations().items()
    ]
    return union_all(found)
