"""Aggregations (AGG-1..12)."""

from pyspark.sql import functions as F

from brokerdw.catalog.registry import query, table
from brokerdw.operators import grouping


@query(
    "daily_totals",
    """
    SELECT o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS datevalue,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS account_daily_total,
           min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
    FROM orders GROUP BY 1, 2
    """,
)
def daily_totals(spark, sf):
    """Grouped sum, min and max (AGG-1, AGG-2)."""
    return (
        table(spark, sf, "orders")
        .groupBy("o_custkey", F.to_date("o_orderdate").alias("datevalue"))
        .agg(
            F.sum(F.col("o_totalprice").cast("decimal(18,4)")).cast("double").alias("account_daily_total"),
            F.min("o_orderkey").alias("first_key"),
            F.max("o_orderkey").alias("last_key"),
        )
    )


@query(
    "latest_record",
    """
    SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    """,
)
def latest_record(spark, sf):
    orders = table(spark, sf, "orders")
    return grouping.latest_record(
        orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderstatus", "o_totalprice"]
    )


@query(
    "cond_min_max",
    """
    SELECT user_id, CAST(strftime(min(CASE WHEN event_type <> 'error' THEN ts END), '%Y%m%d%H%M%S') AS BIGINT) AS placed,
           CAST(strftime(max(CASE WHEN event_type = 'error' THEN ts END), '%Y%m%d%H%M%S') AS BIGINT) AS removed,
           min(event_id) AS first_event
    FROM events GROUP BY 1
    """,
)
def cond_min_max(spark, sf):
    events = table(spark, sf, "events")
    found = grouping.placed_removed(
        events, ["user_id"], "ts", "event_type", "error", extra=[F.min("event_id").alias("first_event")]
    )
    stamp = lambda c: F.date_format(c, "yyyyMMddHHmmss").cast("bigint").alias(c)
    return found.select("user_id", stamp("placed"), stamp("removed"), "first_event")


SNAPSHOTS = """
    snap AS (
      SELECT c_custkey, c_name, CASE WHEN b.batchid = 3 AND c_custkey % 5 = 0 THEN 'CHANGED' ELSE c_mktsegment END
               AS segment, b.batchid
      FROM customer CROSS JOIN (VALUES (1), (2), (3)) b(batchid)
      WHERE NOT (b.batchid = 2 AND c_custkey % 7 = 0) AND NOT (b.batchid = 3 AND c_custkey % 11 = 0))
"""


def snapshots(spark, sf):
    """Three full snapshots of the customers with missing and changed rows."""
    key, batch = F.col("c_custkey"), F.col("batchid")
    rows = table(spark, sf, "customer").select(
        key, "c_name", "c_mktsegment", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("batchid")
    )
    seen = rows.filter(~((batch == 2) & (key % 7 == 0)) & ~((batch == 3) & (key % 11 == 0)))
    segment = F.when((batch == 3) & (key % 5 == 0), F.lit("CHANGED")).otherwise(F.col("c_mktsegment"))
    return seen.select(key, "c_name", segment.alias("segment"), batch)


@query(
    "first_last_seen",
    f"WITH {SNAPSHOTS} SELECT c_custkey, c_name, segment, max(batchid) AS recordbatchid, min(batchid) AS batchid "
    "FROM snap GROUP BY 1, 2, 3",
)
def first_last_seen(spark, sf):
    return grouping.first_last_seen(snapshots(spark, sf))


@query(
    "latest_snapshot_row",
    f"""
    WITH {SNAPSHOTS}
    SELECT c_custkey, arg_max(c_name, batchid) AS c_name, arg_max(segment, batchid) AS segment,
           max(batchid) AS recordbatchid, min(batchid) AS batchid FROM snap GROUP BY 1
    """,
)
def latest_snapshot_row(spark, sf):
    return grouping.latest_snapshot_row(snapshots(spark, sf), ["c_custkey"])


@query(
    "snapshot_visible",
    f"""
    WITH {SNAPSHOTS}, g AS (SELECT c_custkey, c_name, segment, max(batchid) AS recordbatchid, min(batchid) AS batchid
                            FROM snap GROUP BY 1, 2, 3)
    SELECT c_custkey, c_name, segment, least(recordbatchid, 2) AS recordbatchid, batchid
    FROM g WHERE batchid <= 2 AND recordbatchid >= 2
    """,
)
def snapshot_visible(spark, sf):
    """Records visible at batch 2 (MRG-7)."""
    return grouping.snapshot_as_of(grouping.first_last_seen(snapshots(spark, sf)), 2)


@query(
    "having_distinct",
    """
    SELECT l_suppkey, count(*) AS n, count(DISTINCT l_partkey) AS parts,
           count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey END) AS returned
    FROM lineitem GROUP BY 1 HAVING count(*) > 30
    """,
)
def having_distinct(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.countDistinct("l_partkey").alias("parts"),
            F.countDistinct(F.when(F.col("l_returnflag") == "R", F.col("l_orderkey"))).alias("returned"),
        )
        .filter(F.col("n") > 30)
    )


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark, sf):
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@query(
    "rule_violation_sum",
    """
    SELECT l_returnflag,
           CAST(sum(CASE WHEN l_tax > l_discount THEN 1 ELSE 0 END) AS BIGINT) AS tax_over,
           CAST(sum(CASE WHEN l_quantity NOT BETWEEN 5 AND 45 THEN 1 ELSE 0 END) AS BIGINT) AS qty_out,
           min(CAST(l_shipdate AS DATE))::VARCHAR AS first_day
    FROM lineitem GROUP BY 1
    """,
)
def rule_violation_sum(spark, sf):
    flag = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_returnflag")
        .agg(
            flag(F.col("l_tax") > F.col("l_discount")).alias("tax_over"),
            flag(~F.col("l_quantity").between(5, 45)).alias("qty_out"),
            F.min(F.to_date("l_shipdate")).alias("first_day"),
        )
    )
