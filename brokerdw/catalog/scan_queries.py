"""Scans and sinks (SRC-1..13, SNK-1..7): given tables are written as raw files and read back."""

from pyspark.sql import functions as F

from brokerdw.catalog.registry import query, table
from brokerdw.session import scratch_dir
from brokerdw.sources import scans
from brokerdw.sources.store import TableStore

FILES = "part-*"


def _write_batches(df, root, batch, sep="|", batches=(1, 2, 3)):
    """One folder of delimited text per batch, as the raw extracts arrive."""
    for n in batches:
        rows = df.filter(F.col(batch) == n).drop(batch)
        rows.write.option("sep", sep).option("emptyValue", "").csv(f"{root}/Batch{n}")


def _orders(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        F.to_date("o_orderdate").alias("o_orderdate"),
        (F.col("o_orderkey") % 3 + 1).alias("b"),
    )


ORDER_SCHEMA = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate DATE"
ORDER_SQL = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate
"""


@query("scan_delimited", ORDER_SQL + "FROM orders")
def scan_delimited(spark, sf):
    root = scratch_dir(spark, "delimited")
    _write_batches(_orders(spark, sf), root, "b")
    return scans.scan_delimited(spark, f"{root}/Batch*", ORDER_SCHEMA, "|", pattern=FILES)


@query("batch_id_scan", ORDER_SQL + ", o_orderkey % 3 + 1 AS batchid FROM orders WHERE o_orderkey % 3 > 0")
def batch_id_scan(spark, sf):
    """Brace glob over later batches, batch number from the path (SRC-9, SRC-10)."""
    root = scratch_dir(spark, "batchid")
    _write_batches(_orders(spark, sf), root, "b")
    return scans.with_batch_id(scans.scan_delimited(spark, f"{root}/Batch{{2,3}}", ORDER_SCHEMA, "|", pattern=FILES))


@query("scan_text_split", "SELECT o_orderkey, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderkey % 3 + 1 AS batchid FROM orders")
def scan_text_split(spark, sf):
    root = scratch_dir(spark, "text")
    _write_batches(_orders(spark, sf), root, "b")
    fields = [("o_orderkey", 0, "bigint"), ("o_totalprice", 3, "double"), ("o_orderdate", 4, "date")]
    return scans.with_batch_id(scans.scan_text_split(spark, f"{root}/Batch[123]", "|", fields, FILES))


@query(
    "scan_header_csv",
    """
    SELECT o_orderstatus AS dataset, CAST(o_orderkey % 3 + 1 AS INT) AS batchid,
           CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS date, 'N' AS attribute, count(*) AS value,
           CAST(CAST(max(o_totalprice) AS DECIMAL(15,5)) AS DOUBLE) AS dvalue
    FROM orders GROUP BY 1, 2
    """,
)
def scan_header_csv(spark, sf):
    """Header file with a decimal column (SRC-2, DP-24)."""
    from brokerdw.sources.schemas import AUDIT

    root = scratch_dir(spark, "audit")
    facts = (
        _orders(spark, sf)
        .groupBy(F.col("o_orderstatus").alias("dataset"), F.col("b").alias("batchid"))
        .agg(
            F.min("o_orderdate").alias("date"),
            F.lit("N").alias("attribute"),
            F.count(F.lit(1)).alias("value"),
            F.max("o_totalprice").cast("decimal(15,5)").alias("dvalue"),
        )
    )
    facts.write.option("header", True).csv(f"{root}/Batch1")
    audit = scans.scan_delimited(spark, f"{root}/*", AUDIT, ",", header=True, pattern="*.csv")
    return audit.withColumn("dvalue", F.col("dvalue").cast("double"))


def _wire_lines(spark, sf):
    """Security lines from parts, company lines and two kinds of financial lines from suppliers."""
    head = lambda kind: F.concat(F.lit("19980405-120000"), F.lit(kind))
    pad = lambda c, n: F.rpad(F.coalesce(c.cast("string"), F.lit("")), n, " ")
    zero = lambda c, n: F.lpad(c.cast("string"), n, "0")
    part = table(spark, sf, "part")
    sec = part.select(
        F.concat(
            head("SEC"),
            pad(F.concat(F.lit("S"), F.col("p_partkey")), 15),
            pad(F.lit("COMMON"), 6),
            pad(F.lit("ACTV"), 4),
            pad(F.col("p_name"), 70),
            pad(F.lit("NYSE"), 6),
            zero(F.col("p_size"), 13),
            F.when(F.col("p_partkey") % 5 == 0, pad(F.lit(""), 8)).otherwise(F.lit("19970102")),
            F.lit("19970103"),
            pad(F.col("p_retailprice"), 12),
            pad(F.col("p_brand"), 60),
        ).alias("value")
    )
    supplier = table(spark, sf, "supplier")
    ref = F.when(F.col("s_suppkey") % 2 == 0, zero(F.col("s_suppkey"), 10)).otherwise(F.col("s_name"))
    fin = supplier.select(
        F.concat(
            head("FIN"),
            F.lit("1998"),
            F.lit("2"),
            F.lit("19980401"),
            F.lit("19980401"),
            *[zero(F.col("s_suppkey"), n) for n in (17, 17)],
            pad(F.col("s_acctbal"), 12),
            *[pad(F.lit("1.5"), n) for n in (12, 12)],
            *[pad(F.lit(""), n) for n in (17, 17, 17)],
            *[zero(F.col("s_nationkey"), n) for n in (13, 13)],
            pad(ref, 60),
        ).alias("value")
    )
    cmp = supplier.select(
        F.concat(
            head("CMP"),
            pad(F.col("s_name"), 60),
            zero(F.col("s_suppkey"), 10),
            pad(F.lit("ACTV"), 4),
            pad(F.lit("HR"), 2),
            pad(F.lit("BB+"), 4),
            F.lit("19700131"),
            pad(F.lit("1 Main St"), 80),
            pad(F.lit(""), 80),
            pad(F.lit("12345"), 12),
            pad(F.lit("Town"), 25),
            pad(F.lit("ST"), 20),
            pad(F.lit("Land"), 24),
            pad(F.lit("A CEO"), 46),
            pad(F.lit("text"), 150),
        ).alias("value")
    )
    return sec.unionByName(fin).unionByName(cmp)


def _finwire(spark, sf):
    root = scratch_dir(spark, "finwire")
    _wire_lines(spark, sf).write.text(f"{root}/Batch1/FINWIRE1998Q2")
    return scans.scan_finwire(spark, f"{root}/Batch1/FINWIRE[0-9][0-9][0-9][0-9]Q[1-4]")


@query(
    "record_classify",
    """
    SELECT 'SEC' AS rectype, '1998-04-05' AS recdate, count(*) AS n FROM part
    UNION ALL SELECT 'CMP', '1998-04-05', count(*) FROM supplier
    UNION ALL SELECT 'FIN_COMPANYID', '1998-04-05', count(*) FROM supplier WHERE s_suppkey % 2 = 0
    UNION ALL SELECT 'FIN_NAME', '1998-04-05', count(*) FROM supplier WHERE s_suppkey % 2 = 1
    """,
)
def record_classify(spark, sf):
    return _finwire(spark, sf).groupBy("rectype", "recdate").agg(F.count(F.lit(1)).alias("n"))


@query(
    "fixed_width_sec",
    """
    SELECT 'S' || p_partkey AS symbol, p_name AS name, CAST(p_size AS BIGINT) AS sharesoutstanding,
           CASE WHEN p_partkey % 5 <> 0 THEN '1997-01-02' END AS firsttrade, '1997-01-03' AS firsttradeonexchange,
           p_retailprice AS dividend, p_brand AS conameorcik FROM part
    """,
)
def fixed_width_sec(spark, sf):
    return scans.parse_sec(_finwire(spark, sf)).drop("recdate", "issue", "status", "exchangeid")


@query(
    "fixed_width_fin",
    """
    SELECT 1998 AS fi_year, 2 AS fi_qtr, '1998-04-01' AS fi_qtr_start_date, CAST(s_suppkey AS DOUBLE) AS fi_revenue,
           s_acctbal AS fi_basic_eps, 1.5::DOUBLE AS fi_margin, CAST(NULL AS DOUBLE) AS fi_assets,
           CAST(s_nationkey AS BIGINT) AS fi_out_basic,
           CASE WHEN s_suppkey % 2 = 0 THEN lpad(CAST(s_suppkey AS VARCHAR), 10, '0') ELSE s_name END AS conameorcik
    FROM supplier
    """,
)
def fixed_width_fin(spark, sf):
    cols = "fi_year fi_qtr fi_qtr_start_date fi_revenue fi_basic_eps fi_margin fi_assets fi_out_basic conameorcik"
    return scans.parse_fin(_finwire(spark, sf)).select(*cols.split())


@query(
    "fixed_width_cmp",
    """
    SELECT s_name AS companyname, lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS cik, 'HR' AS industryid,
           'BB+' AS sprating, '1970-01-31' AS foundingdate, '' AS addressline2, 'A CEO' AS ceo, 'text' AS description
    FROM supplier
    """,
)
def fixed_width_cmp(spark, sf):
    cols = "companyname cik industryid sprating foundingdate addressline2 ceo description"
    return scans.parse_cmp(_finwire(spark, sf)).select(*cols.split())


XML_SCHEMA = (
    "_ActionType STRING, Customer STRUCT<_C_ID: STRING, Name: STRUCT<C_L_NAME: STRING>, Account: STRUCT<_CA_ID: STRING>>"
)


@query(
    "xml_scan",
    """
    SELECT c_custkey AS customerid, CASE WHEN c_custkey % 2 = 0 THEN 'NEW' ELSE 'UPDCUST' END AS actiontype,
           c_name AS lastname, CASE WHEN c_custkey % 2 = 0 THEN c_custkey * 10 END AS accountid
    FROM customer
    """,
)
def xml_scan(spark, sf):
    from brokerdw.sources.schemas import XML_ROW_TAG

    root = scratch_dir(spark, "xml")
    key = F.col("c_custkey")
    even = key % 2 == 0
    customer = F.struct(
        key.alias("_C_ID"),
        F.struct(F.col("c_name").alias("C_L_NAME")).alias("Name"),
        F.when(even, F.struct((key * 10).alias("_CA_ID"))).alias("Account"),
    )
    action = F.struct(F.when(even, "NEW").otherwise("UPDCUST").alias("_ActionType"), customer.alias("Customer"))
    record = F.to_xml(action, {"rowTag": "Action"})
    for tag in ("<Action", "</Action"):  # the writer accepts no prefixed names
        record = F.replace(record, F.lit(tag), F.lit(tag.replace("Action", XML_ROW_TAG)))
    table(spark, sf, "customer").select(record).write.text(f"{root}/Batch1")
    read = scans.scan_xml(spark, f"{root}/Batch1", XML_ROW_TAG, XML_SCHEMA, FILES)
    return read.select(
        F.col("Customer._C_ID").try_cast("bigint").alias("customerid"),
        F.col("_ActionType").alias("actiontype"),
        F.col("Customer.Name.C_L_NAME").alias("lastname"),
        F.col("Customer.Account._CA_ID").try_cast("bigint").alias("accountid"),
    )


def _action(key, kind):
    """An action of the customer extract with every element it can have."""
    phone = lambda n: F.struct(
        F.when(key % 2 == 0, "1").alias("C_CTRY_CODE"),
        F.when(key % 3 == 0, F.substring("c_mktsegment", 1, 2)).alias("C_AREA_CODE"),
        F.when(key % (n + 3) != 0, F.substring("c_mktsegment", 4, 3)).alias("C_LOCAL"),
        F.when(key % 5 == 0, "99").alias("C_EXT"),
    )
    customer = F.struct(
        key.alias("_C_ID"),
        F.concat(F.lit("T"), key.cast("string")).alias("_C_TAX_ID"),
        F.when(key % 2 == 0, "m").otherwise("").alias("_C_GNDR"),
        F.when(key % 4 != 0, key % 4).alias("_C_TIER"),
        F.lit("1970-01-31").alias("_C_DOB"),
        F.struct(F.col("c_name").alias("C_L_NAME"), F.lit("F & <G>").alias("C_F_NAME")).alias("Name"),
        F.struct(F.col("c_mktsegment").alias("C_CITY"), F.lit("").alias("C_ADLINE2")).alias("Address"),
        F.struct(F.lit("a@b").alias("C_PRIM_EMAIL"), *[phone(n).alias(f"C_PHONE_{n}") for n in (1, 2, 3)]).alias("ContactInfo"),
        F.struct(F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("C_LCL_TX_ID")).alias("TaxInfo"),
        F.when(key % 3 != 0, F.struct((key * 10).alias("_CA_ID"), (key % 3).alias("_CA_TAX_ST"), F.lit("acct").alias("CA_NAME"))).alias("Account"),
    )
    return F.struct(kind.alias("_ActionType"), F.lit("1999-12-31T10:11:12").alias("_ActionTS"), customer.alias("Customer"))


_KINDS = ["NEW", "ADDACCT", "UPDACCT", "UPDCUST", "CLOSEACCT", "INACT"]
_PHONE_SQL = """CASE WHEN c_custkey % {m} <> 0 THEN CASE WHEN c_custkey % 2 = 0 THEN '+1 ' ELSE '' END ||
        CASE WHEN c_custkey % 3 = 0 THEN '(' || substr(c_mktsegment, 1, 2) || ') ' ELSE '' END || substr(c_mktsegment, 4, 3) ||
        CASE WHEN c_custkey % 5 = 0 THEN '99' ELSE '' END END AS phone{n}"""


@query(
    "customer_mgmt_stage",
    f"""
    SELECT c_custkey AS customerid, CASE WHEN c_custkey % 3 <> 0 THEN c_custkey * 10 END AS accountid,
           'T' || c_custkey AS taxid, CASE WHEN c_custkey % 3 <> 0 THEN 'acct' END AS accountdesc,
           CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey % 3 AS TINYINT) END AS taxstatus,
           CASE WHEN c_custkey % 6 < 4 THEN 'Active' ELSE 'Inactive' END AS status, c_name AS lastname,
           'F & <G>' AS firstname, CASE WHEN c_custkey % 2 = 0 THEN 'M' END AS gender,
           CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey % 4 AS TINYINT) END AS tier, '1970-01-31' AS dob,
           NULL AS addressline2, c_mktsegment AS city, {", ".join(_PHONE_SQL.format(m=n + 3, n=n) for n in (1, 2, 3))},
           'a@b' AS email1, 'N' || c_nationkey AS lcl_tx_id, '1999-12-31 10:11:12' AS update_ts,
           ({_KINDS})[CAST(c_custkey % 6 + 1 AS INT)] AS actiontype
    FROM customer
    """,
)
def customer_mgmt_stage(spark, sf):
    """The customer extract from XML to flat rows (DP-7)."""
    from brokerdw.plans.stages import customer_mgmt
    from brokerdw.sources import schemas

    root = scratch_dir(spark, "mgmt")
    key = F.col("c_custkey")
    kind = F.element_at(F.array(*[F.lit(k) for k in _KINDS]), (key % 6 + 1).cast("int"))
    record = F.to_xml(_action(key, kind), {"rowTag": "Action"})
    for tag in ("<Action", "</Action"):
        record = F.replace(record, F.lit(tag), F.lit(tag.replace("Action", schemas.XML_ROW_TAG)))
    table(spark, sf, "customer").select(record).write.text(f"{root}/Batch1")
    flat = customer_mgmt(scans.scan_xml(spark, f"{root}/Batch1", schemas.XML_ROW_TAG, schemas.CUSTOMER_MGMT, FILES))
    cols = (
        "customerid accountid taxid accountdesc taxstatus status lastname firstname gender tier dob addressline2 city "
        "phone1 phone2 phone3 email1 lcl_tx_id"
    )
    return flat.select(*cols.split(), F.col("update_ts").cast("string").alias("update_ts"), "actiontype")


@query(
    "customer_changes",
    f"""
    SELECT c_custkey AS customerid, CASE WHEN c_custkey % 2 = 0 THEN 'Active' ELSE 'Inactive' END AS status, c_name AS lastname,
           CASE WHEN c_custkey % 3 <> 0 THEN 'F' END AS gender, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS city,
           {_PHONE_SQL.format(m=4, n=1)}, c_custkey % 3 + 2 AS batchid
    FROM customer
    """,
)
def customer_changes(spark, sf):
    """Change files of later batches, blanks as null, status and phones decoded (DP-7)."""
    from brokerdw.plans import stages
    from brokerdw.sources import schemas

    key = F.col("c_custkey")
    given = {
        "customerid": key,
        "status": F.when(key % 2 == 0, "ACTV").otherwise("INAC"),
        "lastname": F.col("c_name"),
        "gender": F.when(key % 3 != 0, "f").otherwise(""),
        "city": F.when(key % 5 != 0, F.col("c_mktsegment")).otherwise(""),
        "c_ctry_1": F.when(key % 2 == 0, "1"),
        "c_area_1": F.when(key % 3 == 0, F.substring("c_mktsegment", 1, 2)),
        "c_local_1": F.when(key % 4 != 0, F.substring("c_mktsegment", 4, 3)),
        "c_ext_1": F.when(key % 5 == 0, "99"),
    }
    names = [c.split()[0] for c in schemas.CUSTOMER.split(", ")]
    raw = table(spark, sf, "customer").select(
        (key % 3 + 2).alias("batchid"), F.lit("I").alias("cdc_flag"), key.alias("cdc_dsn"),
        *[given.get(c, F.lit("")).alias(c) for c in names],
    )
    root = scratch_dir(spark, "custcdc")
    raw.write.partitionBy("batchid").option("sep", "|").csv(f"{root}/raw")
    loaded = scans.scan_delimited(spark, f"{root}/raw", f"{schemas.CDC_COLUMNS}, {schemas.CUSTOMER}, batchid INT")
    return stages.customer_changes(loaded).select("customerid", "status", "lastname", "gender", "city", "phone1", "batchid")


@query(
    "account_changes",
    """
    SELECT o_orderkey AS accountid, o_custkey AS customerid, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS accountdesc,
           CAST(o_orderkey % 3 AS TINYINT) AS taxstatus, o_custkey % 7 AS brokerid,
           CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Active' END AS status, o_orderkey % 2 + 2 AS batchid
    FROM orders
    """,
)
def account_changes(spark, sf):
    """Change files of accounts (DP-7)."""
    from brokerdw.plans import stages
    from brokerdw.sources import schemas

    key = F.col("o_orderkey")
    raw = table(spark, sf, "orders").select(
        (key % 2 + 2).alias("batchid"), F.lit("U").alias("cdc_flag"), key.alias("cdc_dsn"), key.alias("accountid"),
        (F.col("o_custkey") % 7).alias("brokerid"), F.col("o_custkey").alias("customerid"),
        F.when(key % 2 == 0, F.col("o_orderpriority")).otherwise("").alias("accountdesc"), (key % 3).alias("taxstatus"),
        F.when(F.col("o_orderstatus") == "F", "CMPT").when(F.col("o_orderstatus") == "O", "ACTV").otherwise("???").alias("status"),
    )
    root = scratch_dir(spark, "acctcdc")
    raw.write.partitionBy("batchid").option("sep", "|").csv(f"{root}/raw")
    loaded = scans.scan_delimited(spark, f"{root}/raw", f"{schemas.CDC_COLUMNS}, {schemas.ACCOUNT}, batchid INT")
    return stages.account_changes(loaded)


@query(
    "metadata_ingest",
    """
    SELECT 'customer' AS name, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys FROM customer
    UNION ALL SELECT 'part', count(*), CAST(sum(p_partkey) AS BIGINT) FROM part
    UNION ALL SELECT 'supplier', count(*), CAST(sum(s_suppkey) AS BIGINT) FROM supplier
    """,
)
def metadata_ingest(spark, sf):
    """One loader over a list of table descriptions (SRC-12)."""
    root = scratch_dir(spark, "ingest")
    specs, key = [], {"customer": "c_custkey", "part": "p_partkey", "supplier": "s_suppkey"}
    for name, col in key.items():
        table(spark, sf, name).select(col).write.csv(f"{root}/Batch1/{name}.txt")
        specs.append(scans.TableSpec(name, FILES, f"{col} BIGINT", batches=f"Batch1/{name}.txt"))
    loaded = scans.ingest(spark, root, specs)
    return scans.union_all(
        [
            loaded[n].agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n"), F.sum(c).alias("keys"))
            for n, c in key.items()
        ]
    )


@query("all_batches_scan", ORDER_SQL + ", CAST(o_orderkey % 3 + 1 AS INT) AS batchid FROM orders")
def all_batches_scan(spark, sf):
    """Batch 1 without and later batches with change columns under one schema (SRC-13)."""
    root = scratch_dir(spark, "cdcscan")
    orders = _orders(spark, sf)
    _write_batches(orders, root, "b", batches=[1])
    flagged = orders.select(F.lit("I").alias("cdc_flag"), F.col("o_orderkey").alias("cdc_dsn"), *orders.columns)
    _write_batches(flagged, root, "b", batches=[2, 3])
    return scans.scan_all_batches(spark, root, scans.TableSpec("orders", FILES, ORDER_SCHEMA))


@query(
    "store_loads",
    """
    SELECT o_orderpriority, o_orderkey, o_totalprice, o_orderkey % 2 = 0 AS closed FROM orders
    """,
)
def store_loads(spark, sf):
    """Overwrite, append, create-if-absent, partitioned and clustered writes, derived column (SNK-1..6)."""
    store = TableStore(spark, scratch_dir(spark, "store"))
    orders = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    closed = {"closed": F.col("o_orderkey") % 2 == 0}
    half = lambda n: orders.filter(F.col("o_orderkey") % 2 == n)
    store.write("orders", orders, derived=closed)
    store.write("orders", half(0), "overwrite", partition_by=["o_orderpriority"], derived=closed)
    store.write("orders", half(1), "append", cluster_by=["o_orderkey"], derived=closed)
    return store.write("orders", orders, "ignore")


@query("temp_view", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def temp_view(spark, sf):
    """A named view over a scan, queried with SQL (SNK-7)."""
    table(spark, sf, "orders").createOrReplaceTempView("brokerdw_orders")
    return spark.sql("SELECT o_orderstatus, count(*) AS n FROM brokerdw_orders GROUP BY o_orderstatus")


@query(
    "store_clustered",
    """SELECT l_partkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS quantity
    FROM lineitem WHERE l_partkey BETWEEN 10 AND 40 OR CAST(l_shipdate AS DATE) BETWEEN DATE '1995-03-01' AND DATE '1995-04-30' GROUP BY ALL""",
)
def store_clustered(spark, sf):
    """A table laid out by two columns at once and read by either (SNK-6)."""
    store = TableStore(spark, scratch_dir(spark, "clustered"))
    lines = table(spark, sf, "lineitem").select("l_partkey", F.to_date("l_shipdate").alias("day"), "l_quantity")
    rows = store.write("lines", lines, cluster_by=["day", "l_partkey"])
    wanted = F.col("l_partkey").between(10, 40) | F.col("day").between("1995-03-01", "1995-04-30")
    return rows.filter(wanted).groupBy("l_partkey", "day").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))
