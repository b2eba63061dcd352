"""Brokerage relations derived from the given tables, and the SQL that derives the same.

Customers act through their orders, suppliers are companies and brokers, parts are
securities, line items are quotes and trades. Every relation grows with the tables.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brokerdw.catalog.registry import table
from brokerdw.functions.exprs import RATINGS, full_years
from brokerdw.operators.grouping import top1
from brokerdw.operators.hotkeys import NO_HOT, carry_last, hot_window_keys, looked_up, row_count
from brokerdw.plans import dimensions as dims
from brokerdw.plans import facts, stages
from brokerdw.plans.audit import FIRST_CALENDAR_DAY
from brokerdw.session import scratch_dir
from brokerdw.sources import scans
from brokerdw.sources.schemas import PROSPECT

# Orders before this day belong to batch 1, later ones feed the change files.
SPLIT = "2000-06-01"
CTE: dict[str, str] = {}


def with_ctes(names: str, body: str) -> str:
    """``body`` after the named common table expressions."""
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n]})" for n in names.split()) + body


# Spark splits a file between row groups; wide text packs so well that a usual group is one task of a long parse.
GROUP_BYTES = 4 << 20


def stored(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), group_bytes: int | None = None) -> DataFrame:
    """Write a stage or dimension to the shared folder and read it back.

    As in the warehouse runs, products read stored dimensions: the lineage is cut, and
    counting keys or planning a broadcast uses a table instead of its whole history.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    writer = df.write.option("parquet.block.size", group_bytes) if group_bytes else df.write
    writer.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# What joins read of a dimension: its key, surrogates and validity. Catalyst drops the rest before it is made and written.
VALID = ["effectivedate", "enddate", "iscurrent"]
CUSTOMER_KEYS = ["customerid", "sk_customerid", *VALID]
ACCOUNT_KEYS = ["accountid", *dims.ACCOUNT_REFS, *VALID]
SECURITY_KEYS = ["symbol", *dims.SECURITY_REFS, *VALID]
HOLDING_COLUMNS = ["tradeid", *facts.HOLDING_REFS, "sk_closedateid", "sk_closetimeid", "tradeprice"]


def stored_keys(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """A dimension stored for joins that look up its surrogates only; no row is left out."""
    return stored(df.select(*columns), name)


def stored_parts(parts: list[DataFrame], name: str) -> DataFrame:
    """The rows of all parts in one folder; each part is a query of its own, so no plan holds them all."""
    spark = parts[0].sparkSession
    path = scratch_dir(spark, name)
    for part in parts:
        part.select(*parts[0].columns).write.mode("append").parquet(path)
    return spark.read.schema(parts[0].schema).parquet(path)


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _day(value: str) -> Column:
    return F.lit(value).cast("date")


def batch_date(spark) -> DataFrame:
    n = F.col("id").cast("int")
    return spark.range(1, 4).select(n.alias("batchid"), F.date_add(_day("2001-12-30"), n).alias("batchdate"))


CTE["batchdate"] = "SELECT i AS batchid, DATE '2001-12-30' + i AS batchdate FROM (VALUES (1), (2), (3)) t(i)"


# -- customers and accounts -------------------------------------------------------
def _broker(key: Column) -> Column:
    return 2 + 4 * (key % 5)


def customer_mgmt(spark, sf) -> DataFrame:
    """Customer and account actions: one opening per customer, one action per order."""
    c, key = table(spark, sf, "customer"), F.col("c_custkey")
    null = F.lit(None)
    opening = {
        "customerid": key,
        "accountid": key * 10,
        "brokerid": _broker(key),
        "accountdesc": F.concat(F.lit("acct "), text(key)),
        "taxstatus": F.lit(1),
        "status": F.lit("Active"),
        "lastname": F.col("c_name"),
        "firstname": F.concat(F.lit("F"), text(key % 7)),
        "gender": F.element_at(F.array(F.lit("m"), F.lit("F"), F.lit("x")), (key % 3 + 1).cast("int")),
        "tier": key % 4,
        "dob": F.date_add(_day("1900-01-01"), (key % 40000).cast("int")),
        "addressline1": F.concat(F.col("c_mktsegment"), F.lit(" "), text(key)),
        "postalcode": text("c_nationkey"),
        "city": F.col("c_mktsegment"),
        "lcl_tx_id": F.concat(F.lit("N"), text("c_nationkey")),
        "nat_tx_id": F.concat(F.lit("N"), text((F.col("c_nationkey") + 1) % 25)),
        "update_ts": F.date_add(_day("1994-01-01"), (key % 300).cast("int")),
        "actiontype": F.lit("NEW"),
    }
    o, ok, ck = table(spark, sf, "orders"), F.col("o_orderkey"), F.col("o_custkey")
    kind = (
        F.when(ok % 5 == 1, "UPDACCT")
        .when(ok % 5 == 2, "ADDACCT")
        .when(ok % 5 == 4, "CLOSEACCT")
        .when(ok % 15 == 3, "INACT")
        .otherwise("UPDCUST")
    )
    adds, updates, person = kind == "ADDACCT", kind == "UPDACCT", kind == "UPDCUST"
    action = {
        "customerid": ck,
        "accountid": F.when(adds, 1000000000 + ok).when(kind.isin("UPDACCT", "CLOSEACCT"), ck * 10),
        "brokerid": F.when(adds | (updates & (ok % 2 == 0)), _broker(ok)),
        "accountdesc": F.when((adds | updates) & (ok % 3 == 0), F.concat(F.lit("desc "), text(ok))),
        "taxstatus": F.when(adds | (updates & (ok % 2 == 1)), ok % 3),
        "status": F.when(kind.isin("CLOSEACCT", "INACT"), "Inactive").otherwise("Active"),
        "tier": F.when(person, F.nullif(ok % 4, F.lit(0))),
        "addressline1": F.when(person & (ok % 4 == 0), F.concat(F.lit("moved "), text(ok))),
        "lcl_tx_id": F.when(person & (ok % 4 == 1), F.concat(F.lit("N"), text(ok % 25))),
        "update_ts": F.expr("o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 86400)"),
        "actiontype": kind,
    }
    kinds = {
        "customerid": "bigint", "accountid": "bigint", "brokerid": "bigint", "taxstatus": "tinyint", "tier": "tinyint",
        "dob": "date", "update_ts": "timestamp",
    }
    wanted = list(dict.fromkeys([*stages.CUSTOMER_COLS, *stages.ACCOUNT_COLS, "update_ts", "actiontype"]))

    def shaped(df: DataFrame, values: dict[str, Column]) -> DataFrame:
        return df.select(*[values.get(n, null).cast(kinds.get(n, "string")).alias(n) for n in wanted])

    early = o.filter(F.to_date("o_orderdate") < _day(SPLIT))
    return shaped(c, opening).unionByName(shaped(early, action))


CTE["mgmt"] = f"""
    SELECT c_custkey AS customerid, c_custkey * 10 AS accountid, 2 + 4 * (c_custkey % 5) AS brokerid,
           'acct ' || c_custkey AS accountdesc, 1 AS taxstatus, 'Active' AS status, c_name AS lastname,
           'F' || (c_custkey % 7) AS firstname, (['m','F','x'])[CAST(c_custkey % 3 + 1 AS INT)] AS gender,
           c_custkey % 4 AS tier, DATE '1900-01-01' + CAST(c_custkey % 40000 AS INT) AS dob,
           c_mktsegment || ' ' || c_custkey AS addressline1, CAST(c_nationkey AS VARCHAR) AS postalcode,
           c_mktsegment AS city, 'N' || c_nationkey AS lcl_tx_id, 'N' || ((c_nationkey + 1) % 25) AS nat_tx_id,
           CAST(DATE '1994-01-01' + CAST(c_custkey % 300 AS INT) AS TIMESTAMP) AS update_ts, 'NEW' AS actiontype
    FROM customer
    UNION ALL
    SELECT o_custkey, CASE k WHEN 'ADDACCT' THEN 1000000000 + o_orderkey WHEN 'UPDACCT' THEN o_custkey * 10
                             WHEN 'CLOSEACCT' THEN o_custkey * 10 END,
           CASE WHEN k = 'ADDACCT' OR (k = 'UPDACCT' AND o_orderkey % 2 = 0) THEN 2 + 4 * (o_orderkey % 5) END,
           CASE WHEN k IN ('ADDACCT', 'UPDACCT') AND o_orderkey % 3 = 0 THEN 'desc ' || o_orderkey END,
           CASE WHEN k = 'ADDACCT' OR (k = 'UPDACCT' AND o_orderkey % 2 = 1) THEN o_orderkey % 3 END,
           CASE WHEN k IN ('CLOSEACCT', 'INACT') THEN 'Inactive' ELSE 'Active' END, NULL, NULL, NULL,
           CASE WHEN k = 'UPDCUST' THEN nullif(o_orderkey % 4, 0) END, NULL,
           CASE WHEN k = 'UPDCUST' AND o_orderkey % 4 = 0 THEN 'moved ' || o_orderkey END, NULL, NULL,
           CASE WHEN k = 'UPDCUST' AND o_orderkey % 4 = 1 THEN 'N' || (o_orderkey % 25) END, NULL,
           o_orderdate + to_seconds(o_orderkey % 86400), k
    FROM (SELECT *, CASE WHEN o_orderkey % 5 = 1 THEN 'UPDACCT' WHEN o_orderkey % 5 = 2 THEN 'ADDACCT'
                         WHEN o_orderkey % 5 = 4 THEN 'CLOSEACCT' WHEN o_orderkey % 15 = 3 THEN 'INACT'
                         ELSE 'UPDCUST' END AS k FROM orders WHERE o_orderdate < TIMESTAMP '{SPLIT}')
"""


def customer_changes(spark, sf) -> DataFrame:
    """One change record for each customer with late orders."""
    key, last = F.col("o_custkey"), F.col("last")
    late = (
        table(spark, sf, "orders")
        .filter(F.to_date("o_orderdate") >= _day(SPLIT))
        .groupBy("o_custkey")
        .agg(F.max("o_orderkey").alias("last"))
    )
    given = {
        "customerid": key,
        "status": F.when(last % 5 == 0, "Inactive").otherwise("Active"),
        "tier": F.nullif(last % 4, F.lit(0)).cast("tinyint"),
        "addressline1": F.when(last % 3 == 0, F.concat(F.lit("late "), text(last))),
        "dob": F.lit(None).cast("date"),
    }
    null = F.lit(None).cast("string")
    cols = [given.get(c, null).alias(c) for c in stages.CUSTOMER_COLS]
    return late.select(*cols, (key % 2 + 2).cast("int").alias("batchid"))


CTE["custchg"] = f"""
    SELECT o_custkey AS customerid, CASE WHEN l % 5 = 0 THEN 'Inactive' ELSE 'Active' END AS status,
           nullif(l % 4, 0) AS tier, CASE WHEN l % 3 = 0 THEN 'late ' || l END AS addressline1,
           CAST(o_custkey % 2 + 2 AS INT) AS batchid
    FROM (SELECT o_custkey, max(o_orderkey) AS l FROM orders
          WHERE o_orderdate >= TIMESTAMP '{SPLIT}' GROUP BY 1)
"""


def account_changes(spark, sf) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        (key * 10).alias("accountid"),
        key.alias("customerid"),
        F.when(key % 2 == 0, F.concat(F.lit("late "), text(key))).alias("accountdesc"),
        F.lit(None).cast("tinyint").alias("taxstatus"),
        F.when(key % 3 != 0, _broker(key)).alias("brokerid"),
        F.when(key % 5 != 0, "Active").alias("status"),
        (key % 2 + 2).cast("int").alias("batchid"),
    )


CTE["acctchg"] = """
    SELECT c_custkey * 10 AS accountid, c_custkey AS customerid,
           CASE WHEN c_custkey % 2 = 0 THEN 'late ' || c_custkey END AS accountdesc, NULL AS taxstatus,
           CASE WHEN c_custkey % 3 <> 0 THEN 2 + 4 * (c_custkey % 5) END AS brokerid,
           CASE WHEN c_custkey % 5 <> 0 THEN 'Active' END AS status, CAST(c_custkey % 2 + 2 AS INT) AS batchid
    FROM customer
"""


def tax_rate(spark, sf) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, sf, "nation").select(
        F.concat(F.lit("N"), text(key)).alias("tx_id"),
        F.col("n_name").alias("tx_name"),
        (key * 0.25).cast("float").alias("tx_rate"),
    )


CTE["tax"] = "SELECT 'N' || n_nationkey AS tx_id, n_name AS tx_name, n_nationkey * 0.25 AS tx_rate FROM nation"


def prospect_snapshots(spark, sf) -> DataFrame:
    """Three full prospect files; a quarter of the prospects is missing from each."""
    key, b = F.col("c_custkey"), F.col("batchid")
    rows = table(spark, sf, "customer").withColumn("batchid", F.explode(F.array(*[F.lit(n) for n in (1, 2, 3)])))
    given = {
        "agencyid": F.concat(F.lit("A"), text(key)),
        "lastname": F.upper("c_name"),
        "firstname": F.concat(F.lit("f"), text(key % 7)),
        "addressline1": F.upper(F.concat(F.col("c_mktsegment"), F.lit(" "), text(key))),
        "addressline2": F.lit(None),
        "postalcode": text("c_nationkey"),
        "country": F.lit("Canada"),
        "income": text(key * 131 % 300000),
        "numbercars": key % 5,
        "numberchildren": key % 6,
        "age": 18 + key % 60,
        "creditrating": 500 + key % 300,
        "numbercreditcards": key % 9,
        "networth": F.round(F.col("c_acctbal") * 200) + F.when((b == 3) & (key % 5 == 0), 1).otherwise(0),
    }
    fields = [f.strip().split(" ") for f in PROSPECT.split(",")]
    cols = [given.get(n, F.lit("")).cast(kind).alias(n) for n, kind in fields if kind == "STRING" or n in given]
    return rows.filter((key + b) % 4 != 0).select(*cols, "batchid")


CTE["psnap"] = """
    SELECT 'A' || c_custkey AS agencyid, c_custkey, upper(c_name) AS lastname, 'f' || (c_custkey % 7) AS firstname,
           upper(c_mktsegment || ' ' || c_custkey) AS addressline1, CAST(c_nationkey AS VARCHAR) AS postalcode,
           c_custkey * 131 % 300000 AS income, c_custkey % 5 AS cars, c_custkey % 6 AS children, 18 + c_custkey % 60 AS age,
           500 + c_custkey % 300 AS creditrating, c_custkey % 9 AS cards,
           CAST(round(c_acctbal * 200) AS INT) + CASE WHEN b = 3 AND c_custkey % 5 = 0 THEN 1 ELSE 0 END AS networth, b AS batchid
    FROM customer CROSS JOIN (VALUES (1), (2), (3)) t(b) WHERE (c_custkey + b) % 4 <> 0
"""
CTE["prospect"] = """
    SELECT *, rtrim(
        CASE WHEN networth > 1000000 OR income > 200000 THEN 'HighValue+' ELSE '' END
        || CASE WHEN children > 3 OR cards > 5 THEN 'Expenses+' ELSE '' END
        || CASE WHEN age > 45 THEN 'Boomer+' ELSE '' END
        || CASE WHEN income < 50000 OR creditrating < 600 OR networth < 100000 THEN 'MoneyAlert+' ELSE '' END
        || CASE WHEN cars > 3 OR cards > 7 THEN 'Spender+' ELSE '' END
        || CASE WHEN age < 25 AND networth > 1000000 THEN 'Inherited+' ELSE '' END, '+') AS plate
    FROM (SELECT agencyid, lastname, firstname, addressline1, postalcode, income, cars, children, age, creditrating, cards,
                 networth, max(batchid) AS recordbatchid, min(batchid) AS batchid
          FROM psnap GROUP BY ALL)
"""


def prospect_stage(spark, sf) -> DataFrame:
    return stages.prospect_stage(prospect_snapshots(spark, sf))


def _visible(stage: DataFrame, n: int) -> DataFrame:
    return stage.filter((F.col("batchid") <= n) & (F.col("recordbatchid") >= n))


def dim_customer(spark, sf, changes: bool = True) -> DataFrame:
    chg = customer_changes(spark, sf) if changes else None
    history = dims.customer_history(customer_mgmt(spark, sf), chg, batch_date(spark))
    batch = 3 if changes else 1
    prospects = looked_up(_visible(prospect_stage(spark, sf), batch), row_count(table(spark, sf, "customer")))
    return dims.build_dim_customer(history, tax_rate(spark, sf), prospects)


def _customer_cte(changes: bool) -> dict[str, str]:
    fill = lambda c: f"last_value({c} IGNORE NULLS) OVER w AS {c}"
    filled = ", ".join(
        fill(c)
        for c in "lastname firstname gender tier dob addressline1 postalcode city lcl_tx_id nat_tx_id".split()
    )
    extra = """
      UNION ALL BY NAME
      SELECT customerid, status, tier, addressline1, c.batchid, CAST(b.batchdate AS TIMESTAMP) AS update_ts
      FROM custchg c JOIN batchdate b ON c.batchid = b.batchid""" if changes else ""
    batch = 3 if changes else 1
    hist = f"""
      SELECT customerid, status, {filled}, batchid, CAST(update_ts AS DATE) AS effectivedate,
             coalesce(CAST(lead(update_ts) OVER w AS DATE), DATE '9999-12-31') AS enddate
      FROM (SELECT customerid, status, lastname, firstname, gender, tier, dob, addressline1, postalcode, city, lcl_tx_id,
                   nat_tx_id, 1 AS batchid, update_ts
            FROM mgmt WHERE actiontype IN ('NEW', 'INACT', 'UPDCUST') {extra})
      WINDOW w AS (PARTITION BY customerid ORDER BY update_ts, batchid)"""
    dim = f"""
      SELECT CAST(strftime(effectivedate, '%Y%m%d') || customerid AS BIGINT) AS sk_customerid, h.customerid, status,
             h.lastname, h.firstname, CASE WHEN upper(gender) IN ('M','F') THEN upper(gender) ELSE 'U' END AS gender, tier,
             dob, h.addressline1, h.postalcode, city, n.tx_name AS nationaltaxratedesc, n.tx_rate AS nationaltaxrate,
             l.tx_name AS localtaxratedesc, l.tx_rate AS localtaxrate, p.agencyid, p.creditrating, p.networth,
             p.plate AS marketingnameplate, enddate = DATE '9999-12-31' AS iscurrent, h.batchid, effectivedate, enddate
      FROM hist h LEFT JOIN tax l ON h.lcl_tx_id = l.tx_id LEFT JOIN tax n ON h.nat_tx_id = n.tx_id
      LEFT JOIN prospect p ON p.batchid <= {batch} AND p.recordbatchid >= {batch}
        AND upper(p.lastname) = upper(h.lastname) AND upper(p.firstname) = upper(h.firstname)
        AND upper(p.addressline1) = upper(h.addressline1) AND upper(p.postalcode) = upper(h.postalcode)
      WHERE effectivedate < enddate"""
    return {"hist": hist, "dimcustomer": dim}


CTE.update(_customer_cte(True))
CTE["hist1"] = _customer_cte(False)["hist"]
CTE["dimcustomer1"] = _customer_cte(False)["dimcustomer"].replace("FROM hist h", "FROM hist1 h")
CUSTOMER = "mgmt custchg batchdate tax psnap prospect hist dimcustomer"


def dim_date(spark, sf) -> DataFrame:
    days = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("datevalue")).distinct()
    return days.select(F.date_format("datevalue", "yyyyMMdd").cast("bigint").alias("sk_dateid"), "datevalue")


def hr(spark, sf) -> DataFrame:
    key = F.col("s_suppkey")
    job = F.when(key % 4 == 0, "100").when(key % 4 == 1, "").otherwise("314")
    return table(spark, sf, "supplier").select(
        key.alias("employeeid"),
        (key % 10).alias("managerid"),
        F.col("s_name").alias("employeefirstname"),
        F.lit("L").alias("employeelastname"),
        F.lit("M").alias("employeemi"),
        job.alias("employeejobcode"),
        text("s_nationkey").alias("employeebranch"),
        F.lit("O").alias("employeeoffice"),
        F.lit("555").alias("employeephone"),
    )


def dim_broker(spark, sf) -> DataFrame:
    return dims.build_dim_broker(hr(spark, sf), dim_date(spark, sf))


CTE["dimbroker"] = """
    SELECT s_suppkey AS sk_brokerid, s_suppkey AS brokerid, s_suppkey % 10 AS managerid, s_name AS firstname,
           CAST(s_nationkey AS VARCHAR) AS branch, (SELECT min(CAST(l_shipdate AS DATE)) FROM lineitem) AS effectivedate
    FROM supplier WHERE s_suppkey % 4 >= 2
"""


def dim_account(spark, sf, customer: DataFrame | None = None, changes: bool = True) -> DataFrame:
    customer = stored_keys(dim_customer(spark, sf, changes), CUSTOMER_KEYS, "dimcustomer") if customer is None else customer
    moves = account_changes(spark, sf) if changes else None
    history = dims.account_history(customer_mgmt(spark, sf), moves, batch_date(spark))
    return dims.build_dim_account(history, customer, dim_broker(spark, sf))


def _account_cte(changes: bool) -> str:
    fill = lambda c: f"last_value({c} IGNORE NULLS) OVER w AS {c}"
    extra = """
        UNION ALL SELECT accountid, customerid, accountdesc, taxstatus, brokerid, status, a.batchid,
               CAST(b.batchdate AS TIMESTAMP) FROM acctchg a JOIN batchdate b ON a.batchid = b.batchid""" if changes else ""
    customers = "dimcustomer" if changes else "dimcustomer1"
    return f"""
      SELECT CAST(strftime(s, '%Y%m%d') || accountid AS BIGINT) AS sk_accountid, accountid, b.sk_brokerid, sk_customerid,
             accountdesc, taxstatus, status, e = DATE '9999-12-31' AS iscurrent, batchid, s AS effectivedate, e AS enddate
      FROM (
        SELECT a.*, c.sk_customerid, greatest(a.effectivedate, coalesce(c.effectivedate, a.effectivedate)) AS s,
               least(a.enddate, coalesce(c.enddate, a.enddate)) AS e
        FROM (
          SELECT accountid, customerid, {fill('accountdesc')}, {fill('taxstatus')}, {fill('brokerid')}, {fill('status')},
                 batchid, CAST(update_ts AS DATE) AS effectivedate,
                 coalesce(CAST(lead(update_ts) OVER w AS DATE), DATE '9999-12-31') AS enddate
          FROM (SELECT accountid, customerid, accountdesc, taxstatus, brokerid, status, 1 AS batchid, update_ts
                FROM mgmt WHERE actiontype NOT IN ('UPDCUST', 'INACT') {extra})
          WINDOW w AS (PARTITION BY accountid ORDER BY update_ts, batchid)) a
        LEFT JOIN {customers} c ON a.customerid = c.customerid AND c.enddate > a.effectivedate AND c.effectivedate < a.enddate
        WHERE a.effectivedate < a.enddate) x
      JOIN dimbroker b ON x.brokerid = b.brokerid WHERE s < e"""


CTE["dimaccount"] = _account_cte(True)
CTE["dimaccount1"] = _account_cte(False)
ACCOUNT = f"{CUSTOMER} dimbroker acctchg dimaccount"


# -- companies and securities -----------------------------------------------------
def _pad(c: Column | str, n: int) -> Column:
    return F.rpad(F.coalesce(text(c) if not isinstance(c, str) else F.lit(c), F.lit("")), n, " ")


def _head(day: str, kind: str) -> Column:
    return F.concat(F.date_format(day, "yyyyMMdd"), F.lit(f"-120000{kind}"))


def finwire(spark, sf) -> DataFrame:
    """Fixed-width company, security and financial records, staged by record type."""
    return stored(scans.classify_finwire(wire_lines(spark, sf)), "finwire", ("rectype",), GROUP_BYTES)


def wire_lines(spark, sf) -> DataFrame:
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    line = table(spark, sf, "lineitem")
    # Company and financial records come from the same quarters, which are counted once.
    quarters = (
        line.groupBy("l_suppkey", F.to_date(F.date_trunc("quarter", "l_shipdate")).alias("q"))
        .agg(F.min(F.to_date("l_shipdate")).alias("d"), F.count(F.lit(1)).alias("n"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .withColumn("filed", F.date_add("q", 40))
    )
    score = (F.col("s_suppkey") + F.month("d")) % 24
    ratings = F.array(*[F.lit(r) for r in [*RATINGS, "ZZZ", ""]])
    cmp = F.concat(
        _head("d", "CMP"),
        _pad(F.col("s_name"), 60),
        F.lpad(text("s_suppkey"), 10, "0"),
        _pad(F.when(F.dayofmonth("d") % 5 == 0, "INAC").otherwise("ACTV"), 4),
        _pad(F.lpad(text("s_nationkey"), 2, "0"), 2),
        _pad(F.element_at(ratings, (score + 1).cast("int")), 4),
        F.when(F.month("d") == 1, _pad("", 8)).otherwise(F.lit("19700131")),
        *[_pad(w, n) for w, n in [("1 Main St", 80), ("", 80), ("12345", 12), ("Town", 25), ("ST", 20), ("", 24)]],
        _pad(F.concat(F.lit("CEO "), text(F.year("d"))), 46),
        _pad("about", 150),
    )
    securities = (
        line.groupBy("l_partkey", F.year("l_shipdate"))
        .agg(
            F.min(F.to_date("l_shipdate")).alias("d"),
            F.max_by(F.struct("l_suppkey", "l_tax", "l_orderkey"), F.struct("l_orderkey", "l_suppkey", "l_tax")).alias("r"),
        )
        .select("l_partkey", "d", "r.*")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    ref = F.when(F.col("l_orderkey") % 2 == 0, F.lpad(text("s_suppkey"), 10, "0")).otherwise(F.col("s_name"))
    sec = securities.select(
        F.concat(
            _head("d", "SEC"),
            _pad(F.concat(F.lit("S"), text("l_partkey")), 15),
            _pad("COMMON", 6),
            _pad("ACTV", 4),
            _pad(F.concat(F.lit("share "), text("l_partkey")), 70),
            _pad("NYSE", 6),
            F.lpad(text("l_orderkey"), 13, "0"),
            F.lit("1990010219900103"),
            _pad(F.col("l_tax") * 100, 12),
            _pad(ref, 60),
        ).alias("value")
    )
    by_number = F.when(F.month("q") < 7, F.lpad(text("s_suppkey"), 10, "0")).otherwise(F.col("s_name"))
    eps = F.col("n") / 4
    fin = F.concat(
        _head("filed", "FIN"),
        text(F.year("q")),
        text(F.quarter("q")),
        F.date_format("q", "yyyyMMdd"),
        F.date_format("q", "yyyyMMdd"),
        _pad(F.col("n") * 1000, 17),
        _pad(F.col("n") * 25, 17),
        _pad(eps, 12),
        _pad(eps, 12),
        *[_pad("", n) for n in (12, 17, 17, 17)],
        _pad("100", 13),
        _pad("", 13),
        _pad(by_number, 60),
    )
    return quarters.select(F.explode(F.array(cmp, fin)).alias("value")).unionByName(sec)


def industry(spark, sf) -> DataFrame:
    nation = table(spark, sf, "nation")
    return nation.select(F.lpad(text("n_nationkey"), 2, "0").alias("in_id"), F.col("n_name").alias("in_name"))


_RATING_LIST = ", ".join(f"'{r}'" for r in [*RATINGS, "ZZZ", ""])
CTE["dimcompany"] = f"""
    SELECT CAST(strftime(d, '%Y%m%d') || companyid AS BIGINT) AS sk_companyid, companyid, name,
           CASE WHEN day(d) % 5 = 0 THEN 'Inactive' ELSE 'Active' END AS status, industry,
           CASE WHEN r NOT IN ('ZZZ', '') THEN r END AS sprating,
           CASE WHEN r IN ('AAA','AA+','AA','AA-','A+','A','A-','BBB+','BBB','BBB-') THEN FALSE
                WHEN r NOT IN ('ZZZ', '') THEN TRUE END AS islowgrade,
           'CEO ' || year(d) AS ceo, CASE WHEN month(d) <> 1 THEN DATE '1970-01-31' END AS foundingdate,
           enddate = DATE '9999-12-31' AS iscurrent, d AS effectivedate, enddate
    FROM (SELECT s_suppkey AS companyid, s_name AS name, n_name AS industry, d,
                 ([{_RATING_LIST}])[CAST((s_suppkey + month(d)) % 24 + 1 AS INT)] AS r,
                 coalesce(lead(d) OVER (PARTITION BY s_suppkey ORDER BY d), DATE '9999-12-31') AS enddate
          FROM (SELECT l_suppkey, CAST(min(l_shipdate) AS DATE) AS d FROM lineitem GROUP BY l_suppkey, date_trunc('quarter', l_shipdate))
          JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON n_nationkey = s_nationkey)
"""
CTE["dimsecurity"] = """
    SELECT CAST('0x' || substr(md5(symbol || '|' || CAST(greatest(s.d, c.effectivedate) AS VARCHAR)), 1, 15) AS BIGINT)
             AS sk_securityid,
           symbol, sk_companyid, shares AS sharesoutstanding, dividend, greatest(s.d, c.effectivedate) AS effectivedate,
           least(s.e, c.enddate) AS enddate, least(s.e, c.enddate) = DATE '9999-12-31' AS iscurrent
    FROM (SELECT 'S' || l_partkey AS symbol, d, l_suppkey, shares, dividend,
                 coalesce(lead(d) OVER (PARTITION BY l_partkey ORDER BY d), DATE '9999-12-31') AS e
          FROM (SELECT l_partkey, CAST(min(l_shipdate) AS DATE) AS d, arg_max(l_suppkey, (l_orderkey, l_suppkey, l_tax)) AS l_suppkey,
                       max(l_orderkey) AS shares, arg_max(l_tax, (l_orderkey, l_suppkey, l_tax)) * 100 AS dividend
                FROM lineitem GROUP BY l_partkey, year(l_shipdate))) s
    JOIN dimcompany c ON s.l_suppkey = c.companyid AND s.d < c.enddate AND s.e > c.effectivedate
"""
CTE["financial"] = """
    SELECT sk_companyid, companyid, CAST(year(q) AS INT) AS fi_year, CAST(quarter(q) AS INT) AS fi_qtr,
           q AS fi_qtr_start_date, CAST(n * 1000 AS DOUBLE) AS fi_revenue, CAST(n * 25 AS DOUBLE) AS fi_net_earn,
           n / 4 AS fi_basic_eps, 100::BIGINT AS fi_out_basic
    FROM (SELECT l_suppkey, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS q, count(*) AS n FROM lineitem GROUP BY 1, 2) f
    JOIN dimcompany c ON f.l_suppkey = c.companyid AND q + 40 >= c.effectivedate AND q + 40 < c.enddate
"""


def dim_company(spark, sf, wire: DataFrame | None = None) -> DataFrame:
    return dims.build_dim_company(finwire(spark, sf) if wire is None else wire, industry(spark, sf))


def company_tables(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The staged wire records and the stored company dimension."""
    wire = finwire(spark, sf)
    return wire, stored(dim_company(spark, sf, wire), "dimcompany")


def dim_security(spark, sf) -> DataFrame:
    return dims.build_dim_security(*company_tables(spark, sf))


def financial(spark, sf) -> DataFrame:
    return dims.build_financial(*company_tables(spark, sf))


# -- trades and facts ---------------------------------------------------------------
def trades(spark, sf) -> DataFrame:
    """One line of each order as a trade; some pending trades are completed by change rows."""
    line = table(spark, sf, "lineitem")
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax", "l_discount"]
    one = top1(line.select(*cols), ["l_orderkey"], ["l_partkey", "l_suppkey", "l_extendedprice"])
    orders = table(spark, sf, "orders")
    joined = one.join(looked_up(orders, row_count(orders)), F.col("l_orderkey") == F.col("o_orderkey"))
    key = F.col("o_orderkey")
    placed = F.col("o_orderdate").cast("timestamp") + F.expr("make_dt_interval(0, 9, 0, o_orderkey % 3000)")
    kinds = F.array(*[F.lit(k) for k in ["TMB", "TMS", "TSL", "TLS", "TLB", "XXX"]])
    base = joined.select(
        key.alias("tradeid"),
        placed.alias("placed"),
        (F.when(key % 7 == 0, "CNCL").when(key % 7 < 5, "CMPT").otherwise("PNDG")).alias("status"),
        F.element_at(kinds, (key % 6 + 1).cast("int")).alias("t_tt_id"),
        (key % 2).cast("tinyint").alias("cashflag"),
        F.concat(F.lit("S"), text("l_partkey")).alias("t_s_symb"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("bidprice"),
        (F.col("o_custkey") * 10).alias("t_ca_id"),
        F.lit("Exec").alias("executedby"),
        (F.col("l_extendedprice") / 16).alias("tradeprice"),
        (F.col("l_tax") * 50).alias("fee"),
        (F.col("l_discount") * 1000000).alias("commission"),
        F.col("l_tax").alias("tax"),
    )
    base = stored(base, "trade-base")  # read by the first rows, the changes and the history
    first = base.select(
        F.lit(None).cast("string").alias("cdc_flag"),
        F.lit(None).cast("bigint").alias("cdc_dsn"),
        "*",
        F.col("placed").alias("t_dts"),
        F.lit(1).alias("batchid"),
    )
    updates = base.filter((F.col("tradeid") % 7 > 4) & (F.col("tradeid") % 2 == 0)).select(
        F.lit("U").alias("cdc_flag"),
        F.col("tradeid").alias("cdc_dsn"),
        *[F.lit("CMPT").alias("status") if c == "status" else F.col(c) for c in base.columns],
        F.lit("2002-01-01 10:11:12").cast("timestamp").alias("t_dts"),
        F.lit(2).alias("batchid"),
    )
    changed = updates.withColumn("fee", F.col("fee") + 1)
    return first.unionByName(changed).drop("placed")


def trade_history(spark, sf, rows: DataFrame | None = None) -> DataFrame:
    """The steps of each trade of batch 1; ``rows`` are those of :func:`trades`."""
    rows = trades(spark, sf) if rows is None else rows
    first = rows.filter(F.col("batchid") == 1).select("tradeid", "t_dts", "status")
    done = first.filter(F.col("status") != "PNDG").select(
        "tradeid", (F.col("t_dts") + F.expr("INTERVAL 30 HOURS")).alias("th_dts"), "status"
    )
    sent = first.select("tradeid", F.col("t_dts").alias("th_dts"), F.lit("SBMT").alias("status"))
    pending = first.filter(F.col("status") == "PNDG").select(
        "tradeid", (F.col("t_dts") + F.expr("INTERVAL 1 HOUR")).alias("th_dts"), "status"
    )
    return sent.unionByName(done).unionByName(pending)


def trades_final(spark, sf) -> DataFrame:
    rows = trades(spark, sf)
    return dims.trades_final(rows, trade_history(spark, sf, rows))


def dim_trade(spark, sf) -> DataFrame:
    final = trades_final(spark, sf)
    return dims.build_dim_trade(final, *security_account(spark, sf))


def security_account(spark, sf) -> tuple[DataFrame, DataFrame]:
    security = stored_keys(dim_security(spark, sf), SECURITY_KEYS, "dimsecurity")
    return security, stored_keys(dim_account(spark, sf), ACCOUNT_KEYS, "dimaccount")


CTE["tradesfinal"] = """
    SELECT o_orderkey AS tradeid, ts AS create_ts,
           CASE WHEN upd THEN TIMESTAMP '2002-01-01 10:11:12' WHEN st <> 'PNDG' THEN ts + INTERVAL 30 HOUR END AS close_ts,
           CASE WHEN upd OR st = 'CMPT' THEN 'Completed' WHEN st = 'CNCL' THEN 'Canceled' ELSE 'Pending' END AS status,
           CASE o_orderkey % 6 WHEN 0 THEN 'Market Buy' WHEN 1 THEN 'Market Sell' WHEN 2 THEN 'Stop Loss'
                WHEN 3 THEN 'Limit Sell' WHEN 4 THEN 'Limit Buy' END AS type,
           o_orderkey % 2 = 1 AS cashflag, 'S' || l_partkey AS symbol, CAST(l_quantity AS INT) AS quantity,
           l_extendedprice AS bidprice, o_custkey * 10 AS accountid, l_extendedprice / 16 AS tradeprice,
           l_tax * 50 + CASE WHEN upd THEN 1 ELSE 0 END AS fee, l_discount * 1000000 AS commission, l_tax AS tax,
           CASE WHEN upd THEN 2 ELSE 1 END AS batchid
    FROM (SELECT *, o_orderdate + INTERVAL 9 HOUR + to_seconds(o_orderkey % 3000) AS ts,
                 CASE WHEN o_orderkey % 7 = 0 THEN 'CNCL' WHEN o_orderkey % 7 < 5 THEN 'CMPT' ELSE 'PNDG' END AS st,
                 o_orderkey % 7 > 4 AND o_orderkey % 2 = 0 AS upd
          FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (
                  PARTITION BY l_orderkey ORDER BY l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1)
          JOIN orders ON l_orderkey = o_orderkey)
"""
CTE["dimtrade"] = """
    SELECT t.tradeid, a.sk_brokerid, CAST(strftime(create_ts, '%Y%m%d') AS BIGINT) AS sk_createdateid,
           CAST(strftime(create_ts, '%H%M%S') AS BIGINT) AS sk_createtimeid,
           CAST(strftime(close_ts, '%Y%m%d') AS BIGINT) AS sk_closedateid,
           CAST(strftime(close_ts, '%H%M%S') AS BIGINT) AS sk_closetimeid, t.status, type, cashflag, sk_securityid,
           sk_companyid, quantity, bidprice, a.sk_customerid, a.sk_accountid, tradeprice, fee, commission, tax, t.batchid
    FROM tradesfinal t
    JOIN dimsecurity s ON s.symbol = t.symbol AND CAST(create_ts AS DATE) >= s.effectivedate AND CAST(create_ts AS DATE) < s.enddate
    JOIN dimaccount a ON a.accountid = t.accountid AND CAST(create_ts AS DATE) >= a.effectivedate
                     AND CAST(create_ts AS DATE) < a.enddate
"""
COMPANY = "dimcompany dimsecurity"
TRADE = f"{ACCOUNT} {COMPANY} tradesfinal dimtrade"


def holdings(spark, sf) -> DataFrame:
    """Every line as a holding change of its order's trade."""
    line = table(spark, sf, "lineitem")
    return line.select(
        (F.col("l_orderkey") - F.col("l_linenumber")).cast("int").alias("hh_h_t_id"),
        F.col("l_orderkey").cast("int").alias("hh_t_id"),
        F.lit(0).alias("hh_before_qty"),
        F.col("l_quantity").cast("int").alias("hh_after_qty"),
        (F.col("l_linenumber") % 3 + 1).cast("int").alias("batchid"),
    )


def cash_transactions(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(
        (F.col("o_custkey") * 10).alias("accountid"),
        F.col("o_orderdate").alias("ct_dts"),
        F.col("o_totalprice").alias("ct_amt"),
        F.lit("x").alias("ct_name"),
        F.when(F.to_date("o_orderdate") < _day(SPLIT), 1).otherwise(2).alias("batchid"),
    )


CTE["cash"] = f"""
    SELECT accountid, d, batchid, CAST(sum(t) OVER (PARTITION BY accountid ORDER BY d) AS DOUBLE) AS cash
    FROM (SELECT o_custkey * 10 AS accountid, CAST(o_orderdate AS DATE) AS d,
                 CASE WHEN o_orderdate < TIMESTAMP '{SPLIT}' THEN 1 ELSE 2 END AS batchid,
                 sum(CAST(o_totalprice AS DECIMAL(18,4))) AS t FROM orders GROUP BY 1, 2, 3)
"""


def _quotes(spark, sf) -> DataFrame:
    day, symbol = F.to_date("l_shipdate").alias("dm_date"), F.concat(F.lit("S"), text("l_partkey")).alias("dm_s_symb")
    rest = ["l_extendedprice", "l_quantity", "l_orderkey", "l_linenumber"]
    return table(spark, sf, "lineitem").select(day, symbol, *rest)


def daily_market(spark, sf, by_symbol: bool = False) -> DataFrame:
    """Quotes of a symbol and day; ``by_symbol`` deals the lines by symbol, for a window over the symbol's days."""
    price, quotes = F.col("l_extendedprice"), _quotes(spark, sf)
    return (
        (quotes.repartition("dm_s_symb") if by_symbol else quotes)
        .groupBy("dm_date", "dm_s_symb")
        .agg(
            F.max_by(price, F.struct("l_orderkey", "l_linenumber", "l_extendedprice")).alias("dm_close"),
            F.max(price).alias("dm_high"),
            F.min(price).alias("dm_low"),
            F.sum("l_quantity").cast("int").alias("dm_vol"),
        )
        .withColumn("batchid", F.when(F.col("dm_date") < _day(SPLIT), 1).otherwise(2))
    )


def market_stage(spark, sf) -> DataFrame:
    """Quotes with the extremes of the last year, in one shuffle of the lines by symbol.

    Lines of a day are rarely many, so combining them before the shuffle sorts much and saves little.
    A symbol with more lines than one task should sort goes the long way: days first, then cells.
    """
    hot = hot_window_keys(_quotes(spark, sf), ["dm_s_symb"])
    return stages.daily_market_stage(daily_market(spark, sf, not hot), hot=None if hot else NO_HOT)


CTE["market"] = f"""
    SELECT *, max(hi) OVER w AS high52, CAST(strftime(arg_max(d, (hi, -date_diff('day', DATE '1970-01-01', d))) OVER w,
             '%Y%m%d') AS BIGINT) AS high52date,
           min(lo) OVER w AS low52, CAST(strftime(arg_min(d, (lo, d)) OVER w, '%Y%m%d') AS BIGINT) AS low52date
    FROM (SELECT CAST(l_shipdate AS DATE) AS d, 'S' || l_partkey AS symbol,
                 arg_max(l_extendedprice, (l_orderkey, l_linenumber, l_extendedprice)) AS cl, max(l_extendedprice) AS hi,
                 min(l_extendedprice) AS lo, CAST(sum(l_quantity) AS INT) AS vol,
                 CASE WHEN CAST(l_shipdate AS DATE) < DATE '{SPLIT}' THEN 1 ELSE 2 END AS batchid
          FROM lineitem GROUP BY ALL)
    WINDOW w AS (PARTITION BY symbol ORDER BY d ROWS BETWEEN 364 PRECEDING AND CURRENT ROW)
"""
CTE["eps"] = """
    SELECT sk_companyid, fi_qtr_start_date AS q, sum(fi_basic_eps) OVER (
        PARTITION BY companyid ORDER BY fi_qtr_start_date ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS sum_eps
    FROM financial
"""

CTE["factmarket"] = """
    SELECT s.sk_securityid, s.sk_companyid, m.symbol, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS sk_dateid, m.batchid,
           CASE WHEN sum_eps <> 0 THEN cl / sum_eps END AS peratio
    FROM market m JOIN dimsecurity s ON s.symbol = m.symbol AND d >= s.effectivedate AND d < s.enddate
    LEFT JOIN eps ON eps.sk_companyid = s.sk_companyid AND quarter(d) = quarter(eps.q) AND year(d) = year(eps.q)
"""
CTE["factcash"] = """
    SELECT sk_customerid, sk_accountid, sk_brokerid, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS sk_dateid, c.batchid
    FROM cash c JOIN dimaccount a ON c.accountid = a.accountid AND d >= a.effectivedate AND d < a.enddate
"""
CTE["factwatch"] = """
    SELECT c.sk_customerid, s.sk_securityid, CAST(strftime(placed, '%Y%m%d') AS BIGINT) AS sk_dateid_dateplaced,
           CAST(strftime(removed, '%Y%m%d') AS BIGINT) AS sk_dateid_dateremoved, w.batchid
    FROM watch w JOIN dimsecurity s ON s.symbol = w.symbol AND placed >= s.effectivedate AND placed < s.enddate
    JOIN dimcustomer c ON c.customerid = w.customerid AND placed >= c.effectivedate AND placed < c.enddate
"""
CTE["factholding"] = """
    SELECT t.* FROM lineitem JOIN dimtrade t ON l_orderkey = t.tradeid
"""
CTE["dimdate"] = """
    SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS sk_dateid, d AS datevalue
    FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)
"""


def watches(spark, sf) -> DataFrame:
    """Orders place and cancel watches of their customer on a few symbols."""
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("w_c_id"),
        F.concat(F.lit("S"), text(key % 50 + 1)).alias("w_s_symb"),
        F.col("o_orderdate").alias("w_dts"),
        F.when(F.col("o_orderstatus") == "F", "CNCL").otherwise("ACTV").alias("w_action"),
        F.when(F.to_date("o_orderdate") < _day(SPLIT), 1).otherwise(2).alias("batchid"),
    )


CTE["watch"] = f"""
    SELECT o_custkey AS customerid, 'S' || (o_orderkey % 50 + 1) AS symbol,
           CAST(min(CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END) AS DATE) AS placed,
           CAST(max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) AS DATE) AS removed,
           min(CASE WHEN o_orderdate < TIMESTAMP '{SPLIT}' THEN 1 ELSE 2 END) AS batchid
    FROM orders GROUP BY 1, 2
"""


class Products(Mapping):
    """All products by name; one that a report reads is built and stored when it is first asked for."""

    def __init__(self, spark, sf, columns: Mapping[str, list[str]] | None = None):
        self.spark, self.sf, self.built, self.columns = spark, sf, {}, columns or {}
        s = self
        self.makers = {
            "finwire": lambda: finwire(spark, sf),
            "dimcustomer": lambda: dim_customer(spark, sf),
            "dimaccount": lambda: dim_account(spark, sf, s["dimcustomer"]),
            "dimcompany": lambda: dim_company(spark, sf, s["finwire"]),
            "dimsecurity": lambda: dims.build_dim_security(s["finwire"], s["dimcompany"]),
            "financial": lambda: dims.build_financial(s["finwire"], s["dimcompany"]),
            "dimtrade": lambda: dims.build_dim_trade(
                trades_final(spark, sf), s["dimsecurity"], s["dimaccount"]
            ),
            "dimdate": lambda: dim_date(spark, sf),
            "dimbroker": lambda: dim_broker(spark, sf),
            "dimtime": lambda: s["dimtrade"].select(F.col("sk_closetimeid").alias("sk_timeid")).filter("sk_timeid IS NOT NULL").distinct(),
            "industry": lambda: industry(spark, sf),
            "taxrate": lambda: tax_rate(spark, sf),
            "statustype": lambda: table(spark, sf, "orders").select(F.col("o_orderstatus").alias("st_id")).distinct(),
            "tradetype": lambda: table(spark, sf, "orders").select(F.col("o_orderpriority").alias("tt_id")).distinct(),
            "factholdings": lambda: facts.build_fact_holdings(holdings(spark, sf), s["dimtrade"]),
            "factcashbalances": lambda: facts.build_fact_cash_balances(
                stages.cash_stage(cash_transactions(spark, sf)), s["dimaccount"]
            ),
            "factmarkethistory": lambda: facts.build_fact_market_history(
                market_stage(spark, sf),
                s["dimsecurity"],
                stages.company_eps_stage(s["financial"], s["dimcompany"]),
            ),
            "factwatches": lambda: facts.build_fact_watches(
                facts.watch_stage(watches(spark, sf)), s["dimsecurity"], s["dimcustomer"]
            ),
            "prospect": lambda: facts.build_prospect(prospect_stage(spark, sf), 3, s["dimcustomer"], batch_date(spark)),
        }

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.built:
            made = self.makers[name]()
            made = made.select(*self.columns[name]) if name in self.columns else made
            self.built[name] = made if name == "finwire" else stored(made, name)  # the wire stage is stored as it is made
        return self.built[name]

    def __iter__(self):
        return iter(self.makers)

    def __len__(self) -> int:
        return len(self.makers)


def warehouse(spark, sf, columns: Mapping[str, list[str]] | None = None) -> Products:
    """The products of one query; of those in ``columns`` it reads these columns, of the others any."""
    return Products(spark, sf, columns)


# -- the audit ----------------------------------------------------------------
def as_of(w: Products, batch: int, day) -> dict[str, DataFrame]:
    """The products as they stood after a batch of day ``day``; batch 0 is the empty start."""
    if batch == 0:
        return {name: w[name].filter(F.lit(False)) for name in w if name != "finwire"}
    seen = lambda df: df.filter(F.col("batchid") <= batch) if "batchid" in df.columns else df
    out = {name: seen(w[name]) for name in w if name not in ("finwire", "factwatches", "prospect")}
    out["dimcustomer"] = out["dimcustomer"].withColumn("iscurrent", F.col("enddate") > F.lit(day))
    placed = facts.watch_stage(seen(watches(w.spark, w.sf)))
    out["factwatches"] = stored(facts.build_fact_watches(placed, w["dimsecurity"], w["dimcustomer"]), "factwatches")
    out["prospect"] = _visible(prospect_stage(w.spark, w.sf), batch)
    return out


def _actions(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Customer and account records of all batches: key, batchid, update_ts, kind and, of customers, tier and dob."""
    days = batch_date(spark).withColumnRenamed("batchdate", "update_ts").withColumn("update_ts", F.col("update_ts").cast("timestamp"))
    mgmt = customer_mgmt(spark, sf).withColumn("batchid", F.lit(1))
    changes = customer_changes(spark, sf).join(days, "batchid").withColumn(
        "actiontype", F.when(F.col("status") == "Inactive", "INACT").otherwise("UPDCUST")
    )
    moves = account_changes(spark, sf).join(days, "batchid").withColumn(
        "actiontype", F.when(F.col("status") == "Inactive", "CLOSEACCT").otherwise("UPDACCT")
    )
    person = ["customerid", "batchid", "update_ts", "actiontype", "tier", "dob"]
    customers = mgmt.filter(F.col("actiontype").isin("NEW", "INACT", "UPDCUST")).select(*person).unionByName(changes.select(*person))
    held = ["accountid", "batchid", "update_ts", "actiontype"]
    accounts = mgmt.filter(F.col("accountid").isNotNull()).select(*held).unionByName(moves.select(*held))
    return customers, accounts


def expected(w: Products, dates: dict) -> DataFrame:
    """What the loads announce: per data set, attribute and batch a count of source records, and the days of each batch.

    A batch's days begin after the batch before it. Counts that a batch has no record for are 0.
    """
    spark, sf = w.spark, w.sf
    customers, accounts = _actions(spark, sf)
    day = F.to_date("update_ts")

    def counted(dataset: str, df: DataFrame, values: dict[str, Column]) -> DataFrame:
        batches = spark.createDataFrame([(b,) for b in dates], "batchid int")
        found = df.groupBy(F.col("batchid").cast("int").alias("batchid")).agg(*[v.cast("bigint").alias(n) for n, v in values.items()])
        every = batches.join(found, "batchid", "left")
        rows = [F.struct(F.lit(n).alias("attribute"), F.coalesce(F.col(n), F.lit(0)).alias("value")) for n in values]
        return every.select(F.lit(dataset).alias("dataset"), "batchid", F.inline(F.array(*rows)))

    rows = F.count(F.lit(1))
    of = lambda kind: F.count_if(F.col("actiontype") == kind)

    def overwritten(df: DataFrame, key: str) -> DataFrame:
        return df.groupBy(key, day.alias("day"), "batchid").agg((rows - 1).alias("n"))

    # A change that leaves a value out keeps the one before it; of a day the last record stays.
    known = carry_last(customers, ["customerid"], ["update_ts", "batchid"], ["tier", "dob"])
    last = known.groupBy("customerid", day.alias("day"), "batchid").agg(
        F.max_by(F.struct("tier", "dob"), F.struct("update_ts", "batchid")).alias("r")
    )
    person = last.select("customerid", "batchid", "r.*").join(batch_date(spark), "batchid").groupBy("customerid", "batchid").agg(
        F.max(F.col("tier").isNull() | ~F.col("tier").isin(1, 2, 3)).alias("tier"),
        F.max(full_years("dob", "batchdate") >= 100).alias("old"),
        F.max(F.col("dob") > F.col("batchdate")).alias("unborn"),
    )
    wire = w["finwire"].withColumn("batchid", F.lit(1))
    records = trades(spark, sf)
    final = records.groupBy("tradeid").agg(
        F.max_by(F.struct("batchid", "status", "fee", "commission", "tradeprice", "quantity"), "batchid").alias("r")
    ).select("r.*")
    worth = F.col("tradeprice") * F.col("quantity")
    parts = [
        counted("DimCustomer", customers, {"C_NEW": of("NEW"), "C_UPDCUST": of("UPDCUST"), "C_INACT": of("INACT")}),
        counted("DimCustomer", overwritten(customers, "customerid"), {"C_ID_HIST": F.sum("n")}),
        counted(
            "DimCustomer",
            person,
            {"C_DOB_TO": F.count_if("old"), "C_DOB_TY": F.count_if("unborn"), "C_TIER_INV": F.count_if("tier")},
        ),
        counted("DimAccount", accounts, {f"CA_{kind}": of(kind) for kind in ("ADDACCT", "CLOSEACCT", "UPDACCT")}),
        counted("DimAccount", overwritten(accounts, "accountid"), {"CA_ID_HIST": F.sum("n")}),
        counted("DimBroker", hr(spark, sf).withColumn("batchid", F.lit(1)), {"HR_BROKERS": F.count_if(F.col("employeejobcode") == "314")}),
        *[
            counted(dataset, wire, {f"FW_{kind}": F.count_if(F.col("rectype").startswith(kind))})
            for dataset, kind in (("DimCompany", "CMP"), ("DimSecurity", "SEC"), ("Financial", "FIN"))
        ],
        counted("DimTrade", records, {"T_NEW": F.count_if(F.coalesce("cdc_flag", F.lit("I")) == "I")}),
        counted(
            "DimTrade",
            final,
            {
                "T_CanceledTrades": F.count_if(F.col("status") == "CNCL"),
                "T_InvalidCommision": F.count_if(F.col("commission") > worth),
                "T_InvalidCharge": F.count_if(F.col("fee") > worth),
            },
        ),
        counted("FactHoldings", holdings(spark, sf), {"HH_RECORDS": rows}),
        counted("FactMarketHistory", daily_market(spark, sf), {"DM_RECORDS": rows}),
        counted("FactWatches", watches(spark, sf), {"WH_RECORDS": rows, "WH_ACTIVE": F.count_if(F.col("w_action") == "ACTV")}),
        counted("Prospect", prospect_snapshots(spark, sf), {"P_RECORDS": rows}),
        counted("Generator", table(spark, sf, "orders").withColumn("batchid", F.lit(1)), {"SOURCE_ORDERS": rows}),
    ]
    first = {b: dates[b - 1] + timedelta(days=1) if b - 1 in dates else date.fromisoformat(FIRST_CALENDAR_DAY) for b in dates}
    bounds = [("Batch", b, attribute, of_batch[b]) for attribute, of_batch in (("FirstDay", first), ("LastDay", dates)) for b in dates]
    days = spark.createDataFrame(bounds, "dataset string, batchid int, attribute string, date date").withColumn("value", F.lit(None).cast("bigint"))
    counts = stored_parts(parts, "expected").withColumn("date", F.lit(None).cast("date"))
    return counts.unionByName(days).withColumn("dvalue", F.lit(None).cast("decimal(15,5)"))
