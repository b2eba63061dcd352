"""Windows (WIN-1..8), type 2 histories and the flagship cash balance."""

from pyspark.sql import functions as F

from brokerdw.catalog.registry import query, table
from brokerdw.functions import exprs as X
from brokerdw.operators import grouping, rolling, temporal
from brokerdw.operators.hotkeys import find_hot_keys

# Row limit used by the `_split` queries so that keys of the test tables are cut.
SMALL = 20

VERSIONS = """
    versions AS (
      SELECT * FROM (
        SELECT o_custkey, o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS effectivedate,
               coalesce(CAST(lead(o_orderdate) OVER w AS DATE), DATE '9999-12-31') AS enddate,
               lead(o_orderdate) OVER w IS NULL AS iscurrent
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
      WHERE effectivedate < enddate)
"""


def customer_versions(spark, sf, hot=None):
    """Type 2 history of each customer: the priority of the latest order."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate")
    return temporal.scd2_history(orders, "o_custkey", "o_orderdate", "o_orderkey", hot=hot).drop("o_orderdate")


CASH = f"""
    WITH {VERSIONS},
    daily AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, sum(CAST(o_totalprice AS DECIMAL(18,4))) AS total
              FROM orders GROUP BY 1, 2),
    bal AS (SELECT o_custkey, d, CAST(sum(total) OVER (PARTITION BY o_custkey ORDER BY d) AS DOUBLE) AS cash FROM daily)
    SELECT b.o_custkey AS accountid,
           CAST(strftime(v.effectivedate, '%Y%m%d') || CAST(b.o_custkey AS VARCHAR) AS BIGINT) AS sk_accountid,
           CAST(strftime(b.d, '%Y%m%d') AS BIGINT) AS sk_dateid, b.cash
    FROM bal b JOIN versions v ON b.o_custkey = v.o_custkey AND b.d >= v.effectivedate AND b.d < v.enddate
"""


def _cash(spark, sf, hot=None):
    orders = table(spark, sf, "orders")
    balance = rolling.running_balance(orders, "o_custkey", "o_orderdate", "o_totalprice")
    joined = temporal.pit_join(
        balance, customer_versions(spark, sf), "o_custkey", "datevalue", dim_cols=["effectivedate"], hot=hot
    )
    return joined.select(
        F.col("o_custkey").alias("accountid"),
        X.smart_key("effectivedate", "o_custkey").alias("sk_accountid"),
        X.date_key("datevalue").alias("sk_dateid"),
        "cash",
    )


@query("cash_balance", CASH)
def cash_balance(spark, sf):
    return _cash(spark, sf)


FILL = """
    SELECT event_id, user_id,
           last_value(CASE WHEN value < 50 THEN NULL ELSE value END IGNORE NULLS)
             OVER (PARTITION BY user_id ORDER BY ts, event_id) AS value,
           last_value(CASE WHEN event_type = 'error' THEN NULL ELSE event_type END IGNORE NULLS)
             OVER (PARTITION BY user_id ORDER BY ts, event_id) AS event_type
    FROM events
"""


def _fill(spark, sf, split=False):
    events = table(spark, sf, "events").select(
        "event_id",
        "user_id",
        "ts",
        F.when(F.col("value") >= 50, F.col("value")).alias("value"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"),
    )
    hot = find_hot_keys(events, ["user_id"], SMALL) if split else None
    return temporal.forward_fill(events, "user_id", ["ts", "event_id"], ["value", "event_type"], hot).drop("ts")


@query("forward_fill", FILL)
def forward_fill(spark, sf):
    return _fill(spark, sf)


@query("forward_fill_split", FILL)
def forward_fill_split(spark, sf):
    """The same with keys cut into cells, as for a key holding a large share of the rows."""
    return _fill(spark, sf, split=True)


SCD2 = f"""
    WITH {VERSIONS}
    SELECT CAST(strftime(effectivedate, '%Y%m%d') || CAST(o_custkey AS VARCHAR) AS BIGINT) AS sk, o_custkey,
           o_orderkey, o_orderpriority, CAST(effectivedate AS VARCHAR) AS effectivedate,
           CAST(enddate AS VARCHAR) AS enddate, iscurrent
    FROM versions
"""


@query("scd2_history", SCD2)
def scd2_history(spark, sf):
    v = customer_versions(spark, sf)
    return v.select(X.smart_key("effectivedate", "o_custkey").alias("sk"), *v.columns)


@query("scd2_history_split", SCD2)
def scd2_history_split(spark, sf):
    hot = find_hot_keys(table(spark, sf, "orders"), ["o_custkey"], 5)
    v = customer_versions(spark, sf, hot)
    return v.select(X.smart_key("effectivedate", "o_custkey").alias("sk"), *v.columns)


@query("scd2_current", f"WITH {VERSIONS} SELECT o_custkey, o_orderkey, o_orderpriority FROM versions WHERE iscurrent")
def scd2_current(spark, sf):
    return customer_versions(spark, sf).filter("iscurrent").select("o_custkey", "o_orderkey", "o_orderpriority")


EXTREMES = """
    WITH m AS (
      SELECT l_partkey, CAST(l_shipdate AS DATE) AS d, l_orderkey, l_linenumber, l_extendedprice AS p FROM lineitem)
    SELECT l_partkey, l_orderkey, l_linenumber,
           min(p) OVER w AS low_value, CAST(arg_min(d, (p, d)) OVER w AS VARCHAR) AS low_date,
           max(p) OVER w AS high_value,
           CAST(arg_max(d, (p, -date_diff('day', DATE '1970-01-01', d))) OVER w AS VARCHAR) AS high_date
    FROM m WINDOW w AS (PARTITION BY l_partkey ORDER BY d, l_orderkey, l_linenumber, p
                        ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)
"""


def _extremes(spark, sf, preceding, split=False):
    market = table(spark, sf, "lineitem").select(
        "l_partkey", F.to_date("l_shipdate").alias("d"), "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    hot = find_hot_keys(market, ["l_partkey"], SMALL) if split else None
    found = rolling.rolling_extremes(
        market, "l_partkey", ["d", "l_orderkey", "l_linenumber", "l_extendedprice"], "l_extendedprice", "l_extendedprice", preceding, hot
    )
    return found.drop("d", "l_extendedprice")


@query("high_low_52w", EXTREMES.format(n=364))
def high_low_52w(spark, sf):
    return _extremes(spark, sf, 364)


@query("high_low_split", EXTREMES.format(n=4))
def high_low_split(spark, sf):
    return _extremes(spark, sf, 4, split=True)


@query(
    "trailing_sum4",
    """
    WITH q AS (SELECT l_suppkey, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS q,
                      sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS eps FROM lineitem GROUP BY 1, 2)
    SELECT l_suppkey, CAST(q AS VARCHAR) AS q,
           CAST(sum(eps) OVER (PARTITION BY l_suppkey ORDER BY q ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS DOUBLE)
             AS trailing_sum,
           CAST(sum(eps) OVER (PARTITION BY l_suppkey ORDER BY q ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) - eps
             AS DOUBLE) AS trailing_sum_b
    FROM q
    """,
)
def trailing_sum4(spark, sf):
    """Both published forms: rows 4..1 preceding, and five rows minus the current one (WIN-5, WIN-5b)."""
    quarters = (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey", F.to_date(F.date_trunc("quarter", "l_shipdate")).alias("q"))
        .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,4)")).alias("eps"))
    )
    first = rolling.trailing_sum(quarters, "l_suppkey", ["q"], "eps")
    second = rolling.trailing_sum(first, "l_suppkey", ["q"], "eps", -4, 0, "five")
    return second.select(
        "l_suppkey",
        "q",
        F.col("trailing_sum").cast("double").alias("trailing_sum"),
        (F.col("five") - F.col("eps")).cast("double").alias("trailing_sum_b"),
    )


@query(
    "top1_per_key",
    """
    SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id DESC) = 1
    """,
)
def top1_per_key(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    return grouping.top1(events, ["user_id"], ["value", "event_id"])


@query(
    "cumulative_agg",
    """
    SELECT o_orderkey % 3 + 1 AS batchid, CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS total,
           CAST(sum(sum(CAST(o_totalprice AS DECIMAL(18,4)))) OVER (ORDER BY o_orderkey % 3 + 1) AS DOUBLE) AS cumulative
    FROM orders GROUP BY 1
    """,
)
def cumulative_agg(spark, sf):
    orders = table(spark, sf, "orders").withColumn("batchid", F.col("o_orderkey") % 3 + 1)
    return rolling.cumulative_by_group(orders, "batchid", "o_totalprice")


@query(
    "running_balance_batches",
    """
    WITH d AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS dv, o_orderkey % 3 + 1 AS batchid,
                      sum(CAST(o_totalprice AS DECIMAL(18,4))) AS t FROM orders GROUP BY 1, 2, 3)
    SELECT o_custkey, CAST(dv AS VARCHAR) AS datevalue,
           CAST(sum(t) OVER (PARTITION BY o_custkey ORDER BY dv) AS DOUBLE) AS cash, batchid FROM d
    """,
)
def running_balance_batches(spark, sf):
    """Daily totals of several batches; rows of one day share its balance (WIN-6, AGG-1)."""
    orders = table(spark, sf, "orders").withColumn("batchid", F.col("o_orderkey") % 3 + 1)
    return rolling.running_balance(orders, "o_custkey", "o_orderdate", "o_totalprice", ["batchid"])
