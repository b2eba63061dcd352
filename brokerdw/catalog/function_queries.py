"""Scalar expressions (FN-1..17) and projections, filters, predicates (PRJ-1..12)."""

from pyspark.sql import functions as F

from brokerdw.catalog.registry import query, table
from brokerdw.functions import exprs as X


@query(
    "decode_status",
    """
    WITH o AS (
      SELECT o_orderkey,
             CASE o_orderkey % 7 WHEN 0 THEN 'ACTV' WHEN 1 THEN 'CMPT' WHEN 2 THEN 'CNCL' WHEN 3 THEN 'PNDG'
                  WHEN 4 THEN 'SBMT' WHEN 5 THEN 'INAC' ELSE 'NONE' END AS st,
             CASE o_orderkey % 6 WHEN 0 THEN 'TMB' WHEN 1 THEN 'TMS' WHEN 2 THEN 'TSL' WHEN 3 THEN 'TLS'
                  WHEN 4 THEN 'TLB' ELSE 'XXX' END AS tt,
             CASE o_orderkey % 3 WHEN 0 THEN 'NEW' WHEN 1 THEN 'CLOSEACCT' ELSE 'UPDCUST' END AS act
      FROM orders)
    SELECT o_orderkey,
           CASE st WHEN 'ACTV' THEN 'Active' WHEN 'CMPT' THEN 'Completed' WHEN 'CNCL' THEN 'Canceled'
                   WHEN 'PNDG' THEN 'Pending' WHEN 'SBMT' THEN 'Submitted' WHEN 'INAC' THEN 'Inactive' END AS status,
           CASE tt WHEN 'TMB' THEN 'Market Buy' WHEN 'TMS' THEN 'Market Sell' WHEN 'TSL' THEN 'Stop Loss'
                   WHEN 'TLS' THEN 'Limit Sell' WHEN 'TLB' THEN 'Limit Buy' END AS trade_type,
           CASE WHEN act = 'CLOSEACCT' THEN 'Inactive' ELSE 'Active' END AS action_status
    FROM o
    """,
)
def decode_status(spark, sf):
    pick = lambda n, names: F.element_at(
        F.array(*[F.lit(c) for c in names]), (F.col("o_orderkey") % n + 1).cast("int")
    )
    codes = table(spark, sf, "orders").select(
        "o_orderkey",
        pick(7, [*X.STATUS_NAMES, "NONE"]).alias("st"),
        pick(6, [*X.TRADE_TYPE_NAMES, "XXX"]).alias("tt"),
        pick(3, ["NEW", "CLOSEACCT", "UPDCUST"]).alias("act"),
    )
    return codes.select(
        "o_orderkey",
        X.decode_status("st").alias("status"),
        X.decode_trade_type("tt").alias("trade_type"),
        X.decode_action("act").alias("action_status"),
    )


@query(
    "phone_format",
    """
    WITH p AS (
      SELECT c_custkey,
             CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN '1' END AS ctry,
             CASE WHEN c_custkey % 4 = 0 THEN '' ELSE CAST(200 + c_nationkey AS VARCHAR) END AS area,
             CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 5 = 1 THEN NULL
                  ELSE CAST(c_custkey AS VARCHAR) END AS local_no,
             CASE WHEN c_custkey % 2 = 0 THEN '99' END AS ext
      FROM customer)
    SELECT c_custkey,
           CASE WHEN nullif(local_no, '') IS NOT NULL THEN
             (CASE WHEN nullif(ctry, '') IS NOT NULL THEN '+' || ctry || ' ' ELSE '' END)
             || (CASE WHEN nullif(area, '') IS NOT NULL THEN '(' || area || ') ' ELSE '' END)
             || local_no || coalesce(ext, '') END AS phone
    FROM p
    """,
)
def phone_format(spark, sf):
    key = F.col("c_custkey")
    text = lambda c: c.cast("string")
    parts = table(spark, sf, "customer").select(
        key,
        F.when(key % 3 == 0, "").when(key % 3 == 1, "1").alias("ctry"),
        F.when(key % 4 == 0, "").otherwise(text(200 + F.col("c_nationkey"))).alias("area"),
        F.when(key % 5 == 0, "").when(key % 5 > 1, text(key)).alias("local_no"),
        F.when(key % 2 == 0, "99").alias("ext"),
    )
    return parts.select("c_custkey", X.format_phone("ctry", "area", "local_no", "ext").alias("phone"))


@query(
    "nameplate",
    """
    WITH p AS (
      SELECT c_custkey, CAST(round(c_acctbal * 200) AS BIGINT) AS networth,
             CAST(CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_custkey * 131 % 300000 END AS BIGINT) AS income,
             c_custkey % 6 AS children, c_custkey % 9 AS cards, 18 + c_custkey % 60 AS age,
             c_custkey % 5 AS cars, 500 + c_custkey % 300 AS credit
      FROM customer),
    t AS (
      SELECT c_custkey,
        CASE WHEN networth > 1000000 OR income > 200000 THEN 'HighValue+' ELSE '' END
        || CASE WHEN children > 3 OR cards > 5 THEN 'Expenses+' ELSE '' END
        || CASE WHEN age > 45 THEN 'Boomer+' ELSE '' END
        || CASE WHEN income < 50000 OR credit < 600 OR networth < 100000 THEN 'MoneyAlert+' ELSE '' END
        || CASE WHEN cars > 3 OR cards > 7 THEN 'Spender+' ELSE '' END
        || CASE WHEN age < 25 AND networth > 1000000 THEN 'Inherited+' ELSE '' END AS tags
      FROM p)
    SELECT c_custkey, rtrim(tags, '+') AS marketingnameplate FROM t
    """,
)
def nameplate(spark, sf):
    key = F.col("c_custkey")
    people = table(spark, sf, "customer").select(
        key,
        F.round(F.col("c_acctbal") * 200).cast("bigint").alias("networth"),
        F.when(key % 11 != 0, (key * 131 % 300000).cast("string")).alias("income"),
        (key % 6).alias("children"),
        (key % 9).alias("cards"),
        (18 + key % 60).alias("age"),
        (key % 5).alias("cars"),
        (500 + key % 300).alias("credit"),
    )
    tags = X.nameplate("networth", "income", "children", "cards", "age", "cars", "credit")
    return people.select("c_custkey", tags.alias("marketingnameplate"))


@query(
    "rating_flag",
    """
    WITH p AS (SELECT p_partkey, (['AAA','BBB-','BB+','D','ZZZ','cc'])[CAST(p_size % 6 + 1 AS INT)] AS r FROM part)
    SELECT p_partkey, CASE WHEN r IN ('AAA','BBB-','BB+','D') THEN r END AS sprating,
           CASE WHEN r IN ('AAA','BBB-') THEN FALSE WHEN r IN ('BB+','D') THEN TRUE END AS islowgrade
    FROM p
    """,
)
def rating_flag(spark, sf):
    names = F.array(*[F.lit(x) for x in ["AAA", "BBB-", "BB+", "D", "ZZZ", "cc"]])
    rated = table(spark, sf, "part").select(
        "p_partkey", F.element_at(names, (F.col("p_size") % 6 + 1).cast("int")).alias("r")
    )
    return rated.select("p_partkey", X.rating("r").alias("sprating"), X.is_low_grade("r").alias("islowgrade"))


@query(
    "blank_to_null_gender",
    """
    WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS seg,
                      (['m','F','x',''])[CAST(c_custkey % 4 + 1 AS INT)] AS g FROM customer)
    SELECT c_custkey, nullif(seg, '') AS segment,
           CASE WHEN upper(g) IN ('M','F') THEN upper(g) ELSE 'U' END AS gender FROM c
    """,
)
def blank_to_null_gender(spark, sf):
    key = F.col("c_custkey")
    letters = F.array(*[F.lit(x) for x in ["m", "F", "x", ""]])
    raw = table(spark, sf, "customer").select(
        key,
        F.when(key % 3 == 0, "").otherwise(F.col("c_mktsegment")).alias("seg"),
        F.element_at(letters, (key % 4 + 1).cast("int")).alias("g"),
    )
    return raw.select(key, X.blank_to_null("seg").alias("segment"), X.norm_gender("g").alias("gender"))


@query(
    "date_time_keys",
    """
    SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS sk_dateid,
           CAST(strftime(ts, '%H%M%S') AS BIGINT) AS sk_timeid,
           CAST(strftime(ts, '%Y%m%d') || CAST(user_id AS VARCHAR) AS BIGINT) AS sk_user
    FROM events
    """,
)
def date_time_keys(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        X.date_key("ts").alias("sk_dateid"),
        X.time_key("ts").alias("sk_timeid"),
        X.smart_key("ts", "user_id").alias("sk_user"),
    )


@query(
    "safe_divide",
    """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_discount <> 0 THEN l_extendedprice / l_discount END AS peratio,
           CASE WHEN l_extendedprice <> 0 THEN l_tax / l_extendedprice END / 100 AS yield,
           least(l_quantity, 25.0) AS capped
    FROM lineitem
    """,
)
def safe_divide(spark, sf):
    price = F.col("l_extendedprice")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.try_divide(price, F.col("l_discount")).alias("peratio"),
        (F.try_divide(F.col("l_tax"), price) / 100).alias("yield"),
        F.least(F.col("l_quantity"), F.lit(25.0)).alias("capped"),
    )


@query(
    "company_ref",
    """
    SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey AS VARCHAR) ELSE s_name END AS ref FROM supplier
    """,
)
def company_ref(spark, sf):
    key = F.col("s_suppkey")
    padded = F.lpad(key.cast("string"), 10, "0")
    return table(spark, sf, "supplier").select(
        key, X.norm_company_ref(F.when(key % 2 == 0, padded).otherwise(F.col("s_name"))).alias("ref")
    )


@query(
    "calendar_functions",
    """
    SELECT o_orderkey, quarter(o_orderdate) AS qtr, year(o_orderdate) AS yr, month(o_orderdate) AS mon,
           day(o_orderdate) AS dom,
           CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 DAY AS DATE)::VARCHAR AS day_before,
           date_sub('year', CAST(o_orderdate AS DATE), DATE '2001-06-15') AS full_years
    FROM orders
    """,
)
def calendar_functions(spark, sf):
    d = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.quarter(d).cast("bigint").alias("qtr"),
        F.year(d).cast("bigint").alias("yr"),
        F.month(d).cast("bigint").alias("mon"),
        F.day(d).cast("bigint").alias("dom"),
        F.date_sub(d, 1).alias("day_before"),
        X.full_years(d, F.lit("2001-06-15").cast("date")).cast("bigint").alias("full_years"),
    )


@query(
    "text_functions",
    """
    SELECT c_custkey, substr(c_name, 1, 8) AS head, position('#' IN c_name) AS hash_at, upper(c_mktsegment) AS seg,
           length(c_name) AS n, replace(c_name, '#', '') AS plain, split_part(c_name, '#', 2) AS tail,
           left(c_mktsegment, 3) AS abbr, trim('  ' || c_name || ' ') AS trimmed, c_name || '/' || c_mktsegment AS joined
    FROM customer
    """,
)
def text_functions(spark, sf):
    name, seg = F.col("c_name"), F.col("c_mktsegment")
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.substring(name, 1, 8).alias("head"),
        F.position(F.lit("#"), name).cast("bigint").alias("hash_at"),
        F.upper(seg).alias("seg"),
        F.length(name).cast("bigint").alias("n"),
        F.replace(name, F.lit("#"), F.lit("")).alias("plain"),
        F.coalesce(F.get(F.split(name, "[#]"), F.lit(1)), F.lit("")).alias("tail"),
        F.left(seg, F.lit(3)).alias("abbr"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.concat(name, F.lit("/"), seg).alias("joined"),
    )


@query(
    "projection_struct",
    """
    SELECT o_orderkey, o_custkey AS customerid, 1 AS batchid, o_totalprice AS price, o_orderpriority AS priority
    FROM orders
    """,
)
def projection_struct(spark, sf):
    """Renames, literals, star-except, struct build and expansion (PRJ-1..3)."""
    packed = table(spark, sf, "orders").select(
        "*", F.struct(F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority")).alias("rec")
    )
    return packed.drop("o_orderstatus", "o_orderdate", "o_totalprice", "o_orderpriority").select(
        "o_orderkey", F.col("o_custkey").alias("customerid"), F.lit(1).alias("batchid"), "rec.*"
    )


@query(
    "filter_predicates",
    """
    SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE l_returnflag IN ('A', 'R') AND l_linestatus NOT IN ('O')
      AND round(l_extendedprice * l_discount, 1) BETWEEN 100 AND 5000
      AND NOT (l_quantity <> 10 AND l_tax IS NULL) AND (l_quantity < 30 OR l_tax > 0.02)
    """,
)
def filter_predicates(spark, sf):
    """IN, NOT IN, BETWEEN on rounded arithmetic, null tests, boolean trees (PRJ-4, 5, 7, 8)."""
    amount = F.round(F.col("l_extendedprice") * F.col("l_discount"), 1)
    qty, tax = F.col("l_quantity"), F.col("l_tax")
    return (
        table(spark, sf, "lineitem")
        .filter(F.col("l_returnflag").isin("A", "R") & ~F.col("l_linestatus").isin("O"))
        .filter(amount.between(100, 5000))
        .filter(~((qty != 10) & tax.isNull()) & ((qty < 30) | (tax > 0.02)))
        .select("l_orderkey", "l_linenumber")
    )


@query(
    "like_patterns",
    """
    SELECT c_custkey, c_name LIKE 'Customer#%' AS tagged, c_name LIKE 'Customer#_________' AS nine,
           c_name NOT LIKE '%99%' AS no99
    FROM customer WHERE c_mktsegment LIKE '%U%'
    """,
)
def like_patterns(spark, sf):
    name = F.col("c_name")
    return (
        table(spark, sf, "customer")
        .filter(F.col("c_mktsegment").like("%U%"))
        .select(
            "c_custkey",
            name.like("Customer#%").alias("tagged"),
            name.like("Customer#_________").alias("nine"),
            (~name.like("%99%")).alias("no99"),
        )
    )


@query(
    "scalar_subquery",
    """
    SELECT o_orderkey, CAST((SELECT min(CAST(o_orderdate AS DATE)) FROM orders) AS VARCHAR) AS effectivedate
    FROM orders WHERE o_totalprice > (SELECT avg(CAST(o_totalprice AS DECIMAL(18,2))) FROM orders)
    """,
)
def scalar_subquery(spark, sf):
    """One-row values used in a projection and in a comparison (PRJ-10, AGG-8)."""
    orders = table(spark, sf, "orders")
    first_day = orders.select(F.min(F.to_date("o_orderdate"))).scalar()
    average = orders.select(F.avg("o_totalprice")).scalar()
    return orders.filter(F.col("o_totalprice") > average).select("o_orderkey", first_day.alias("effectivedate"))


@query(
    "correlated_counts",
    """
    SELECT c_custkey, coalesce((SELECT count(*) FROM orders o WHERE o.o_custkey = c.c_custkey), 0) AS n_orders,
           (SELECT max(o_totalprice) FROM orders o WHERE o.o_custkey = c.c_custkey) AS top_price
    FROM customer c
    """,
)
def correlated_counts(spark, sf):
    """Correlated subqueries written as one aggregate and one left join (PRJ-11, AGG-12)."""
    per_customer = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top_price")
    )
    customer = table(spark, sf, "customer")
    return customer.join(per_customer, customer.c_custkey == per_customer.o_custkey, "left").select(
        "c_custkey", F.coalesce("n", F.lit(0)).alias("n_orders"), "top_price"
    )


@query(
    "stable_row_id",
    """
    SELECT p_partkey, CAST('0x' || substr(md5(CAST(p_partkey AS VARCHAR) || '|' || p_brand), 1, 15) AS BIGINT) AS sk
    FROM part
    """,
)
def stable_row_id(spark, sf):
    """Reproducible surrogate key from the natural key instead of a running number (FN-17)."""
    return table(spark, sf, "part").select("p_partkey", X.stable_key("p_partkey", "p_brand").alias("sk"))
