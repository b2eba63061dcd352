"""Joins (JN-1..20) and set operations."""

from pyspark.sql import functions as F

from brokerdw.catalog.registry import query, table
from brokerdw.catalog.window_queries import VERSIONS, customer_versions
from brokerdw.operators import joins, temporal
from brokerdw.operators.hotkeys import stored

PIT = f"""
    WITH {VERSIONS}
    SELECT l.l_orderkey, l.l_linenumber, o.o_custkey, v.o_orderkey AS version, v.o_orderpriority
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN versions v ON v.o_custkey = o.o_custkey AND CAST(l.l_shipdate AS DATE) >= v.effectivedate
                   AND CAST(l.l_shipdate AS DATE) < v.enddate
"""


def _shipments(spark, sf):
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    order = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return line.join(order, line.l_orderkey == order.o_orderkey).drop("o_orderkey")


def _pit(spark, sf, limit=None):
    dim = customer_versions(spark, sf).withColumnRenamed("o_orderkey", "version")
    hot = temporal.many_versions(dim, ["o_custkey"], limit) if limit else None
    joined = temporal.pit_join(
        _shipments(spark, sf), dim, "o_custkey", "l_shipdate", dim_cols=["version", "o_orderpriority"], hot=hot
    )
    return joined.drop("l_shipdate")


@query("pit_join", PIT)
def pit_join(spark, sf):
    return _pit(spark, sf)


@query("pit_join_split", PIT)
def pit_join_split(spark, sf):
    """Keys with many versions also join on a time cell."""
    return _pit(spark, sf, limit=5)


@query(
    "pit_join_left",
    f"""
    WITH {VERSIONS}
    SELECT e.event_id, v.o_orderkey AS version
    FROM events e LEFT JOIN versions v
      ON v.o_custkey = e.user_id AND CAST(e.ts AS DATE) - INTERVAL 9000 DAY >= v.effectivedate
     AND CAST(e.ts AS DATE) - INTERVAL 9000 DAY < v.enddate
    """,
)
def pit_join_left(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", F.date_sub(F.to_date("ts"), 9000).alias("d"))
    dim = customer_versions(spark, sf).withColumnRenamed("o_orderkey", "version")
    return temporal.pit_join(events, dim, [("user_id", "o_custkey")], "d", "left", ["version"]).select(
        "event_id", "version"
    )


@query(
    "current_join",
    f"""
    WITH {VERSIONS}
    SELECT c.c_custkey, v.o_orderkey AS version, v.o_orderpriority
    FROM customer c JOIN versions v ON v.o_custkey = c.c_custkey AND v.iscurrent
    """,
)
def current_join(spark, sf):
    dim = customer_versions(spark, sf).withColumnRenamed("o_orderkey", "version")
    customer = table(spark, sf, "customer").select("c_custkey")
    return temporal.current_join(customer, dim, [("c_custkey", "o_custkey")], dim_cols=["version", "o_orderpriority"])


def _hist(line, name):
    return f"""
    {name} AS (
      SELECT * FROM (
        SELECT l_suppkey, l_orderkey AS {name}_order, CAST(l_shipdate AS DATE) AS effectivedate,
               coalesce(CAST(lead(l_shipdate) OVER w AS DATE), DATE '9999-12-31') AS enddate
        FROM lineitem WHERE l_linenumber {line}
        WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey))
      WHERE effectivedate < enddate)"""


def _overlap(kind, right_line):
    return f"""
    WITH {_hist(f'<> {right_line}', 'a')}, {_hist(f'= {right_line}', 'b')},
    j AS (SELECT a.l_suppkey, a.a_order, b.b_order,
                 greatest(a.effectivedate, coalesce(b.effectivedate, a.effectivedate)) AS s,
                 least(a.enddate, coalesce(b.enddate, a.enddate)) AS e
          FROM a {kind} JOIN b ON a.l_suppkey = b.l_suppkey
               AND b.enddate > a.effectivedate AND b.effectivedate < a.enddate)
    SELECT l_suppkey, a_order, b_order, CAST(s AS VARCHAR) AS effectivedate, CAST(e AS VARCHAR) AS enddate,
           e = DATE '9999-12-31' AS iscurrent
    FROM j WHERE s < e
    """


def _supplier_history(spark, sf, which, name):
    rows = (
        table(spark, sf, "lineitem")
        .filter(which)
        .select("l_suppkey", F.col("l_orderkey").alias(name), "l_shipdate")
    )
    return temporal.scd2_history(rows, "l_suppkey", "l_shipdate", name).drop("l_shipdate", "iscurrent")


def _interval(spark, sf, how, right_line, limit=None):
    a = _supplier_history(spark, sf, F.col("l_linenumber") != right_line, "a_order")
    b = _supplier_history(spark, sf, F.col("l_linenumber") == right_line, "b_order")
    hot = None
    if limit:
        # Read by the count of versions, by the plain join and by both sweeps.
        a, b = stored(a, "left-history"), stored(b, "right-history")
        both = a.select("l_suppkey", "effectivedate").union(b.select("l_suppkey", "effectivedate"))
        hot = temporal.many_versions(both, ["l_suppkey"], limit)
    return temporal.interval_join(a, b, "l_suppkey", how, ["b_order"], hot)


@query("interval_join", _overlap("INNER", 2))
def interval_join(spark, sf):
    return _interval(spark, sf, "inner", 2)


@query("interval_join_split", _overlap("INNER", 2))
def interval_join_split(spark, sf):
    return _interval(spark, sf, "inner", 2, limit=30)


@query("interval_join_left", _overlap("LEFT", 7))
def interval_join_left(spark, sf):
    """Full outer join reduced to the left side (JN-11)."""
    return _interval(spark, sf, "left", 7)


@query("interval_join_left_split", _overlap("LEFT", 7))
def interval_join_left_split(spark, sf):
    return _interval(spark, sf, "left", 7, limit=30)


@query(
    "union_key_join",
    """
    WITH s AS (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_nationkey AS VARCHAR)
                      ELSE (SELECT n_name FROM nation n WHERE n.n_nationkey = s.s_nationkey) END AS ref
               FROM supplier s)
    SELECT s.s_suppkey, n.n_nationkey FROM s JOIN nation n
      ON s.ref = n.n_name OR s.ref = CAST(n.n_nationkey AS VARCHAR)
    """,
)
def union_key_join(spark, sf):
    nation = table(spark, sf, "nation")
    named = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    ref = F.when(F.col("s_suppkey") % 2 == 0, F.col("s_nationkey").cast("string")).otherwise(F.col("n_name"))
    return temporal.union_key_join(
        named.select("s_suppkey", ref.alias("ref")), nation, "ref", ["n_name", "n_nationkey"], ["n_nationkey"]
    ).drop("ref")


@query(
    "name_match_join",
    """
    WITH l AS (SELECT c_custkey, c_name AS nm, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS line2
               FROM customer),
    r AS (SELECT c_custkey AS matched, lower(c_name) AS nm,
                 CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE lower(c_mktsegment) END AS line2
          FROM customer WHERE c_custkey % 4 <> 1)
    SELECT l.c_custkey, r.matched FROM l LEFT JOIN r
      ON upper(l.nm) = upper(r.nm) AND upper(coalesce(l.line2, '')) = upper(coalesce(r.line2, ''))
    """,
)
def name_match_join(spark, sf):
    customer = table(spark, sf, "customer")
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    left = customer.select(
        key, F.col("c_name").alias("nm"), F.when(key % 3 == 0, "").otherwise(segment).alias("line2")
    )
    right = customer.filter(key % 4 != 1).select(
        key.alias("matched"), F.lower("c_name").alias("nm"), F.when(key % 3 != 0, F.lower(segment)).alias("line2")
    )
    return joins.name_match_join(left, right, ["nm"], ["line2"]).select("c_custkey", "matched")


@query(
    "lookup_join",
    """
    SELECT c.c_custkey, n.n_name, r.r_name, s.n_name AS second_name
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
    JOIN nation s ON s.n_nationkey = (c.c_nationkey + 1) % 25
    """,
)
def lookup_join(spark, sf):
    """Code-table lookups, one table used twice (JN-1, JN-2)."""
    nation = table(spark, sf, "nation")
    region = table(spark, sf, "region")
    second = nation.select(F.col("n_nationkey").alias("k2"), F.col("n_name").alias("second_name"))
    return (
        table(spark, sf, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(second, (F.col("c_nationkey") + 1) % 25 == F.col("k2"))
        .select("c_custkey", "n_name", "r_name", "second_name")
    )


@query(
    "quarter_left_join",
    """
    WITH q AS (SELECT l_suppkey, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS qs,
                      CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) AS rev
               FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2)
    SELECT l.l_orderkey, l.l_linenumber, q.rev FROM lineitem l LEFT JOIN q
      ON q.l_suppkey = l.l_suppkey AND quarter(l.l_shipdate) = quarter(q.qs) AND year(l.l_shipdate) = year(q.qs)
    """,
)
def quarter_left_join(spark, sf):
    line = table(spark, sf, "lineitem")
    quarters = (
        line.filter(F.col("l_returnflag") == "A")
        .groupBy(F.col("l_suppkey").alias("k"), F.year("l_shipdate").alias("y"), F.quarter("l_shipdate").alias("q"))
        .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,4)")).cast("double").alias("rev"))
    )
    same = (
        (F.col("l_suppkey") == F.col("k"))
        & (F.year("l_shipdate") == F.col("y"))
        & (F.quarter("l_shipdate") == F.col("q"))
    )
    return line.join(quarters, same, "left").select("l_orderkey", "l_linenumber", "rev")


@query(
    "full_outer_merge",
    """
    WITH a AS (SELECT o_custkey AS k, max(o_totalprice) AS price, max(o_orderpriority) AS pri FROM orders
               WHERE o_orderkey % 2 = 0 GROUP BY 1),
    b AS (SELECT o_custkey AS k, max(o_totalprice) AS price, max(o_orderpriority) AS pri FROM orders
          WHERE o_orderkey % 2 = 1 GROUP BY 1)
    SELECT coalesce(a.k, b.k) AS k, coalesce(a.price, b.price) AS price, coalesce(a.pri, b.pri) AS pri
    FROM a FULL OUTER JOIN b ON a.k = b.k
    """,
)
def full_outer_merge(spark, sf):
    def source(rest):
        return (
            table(spark, sf, "orders")
            .filter(F.col("o_orderkey") % 2 == rest)
            .groupBy(F.col("o_custkey").alias("k"))
            .agg(F.max("o_totalprice").alias("price"), F.max("o_orderpriority").alias("pri"))
        )

    return joins.coalesce_outer(source(0), source(1), ["k"], ["price", "pri"])


@query("using_join", "SELECT n_nationkey, n_name, r_name FROM nation JOIN (SELECT r_regionkey AS n_regionkey, r_name FROM region) USING (n_regionkey)")
def using_join(spark, sf):
    region = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return table(spark, sf, "nation").join(region, on="n_regionkey").select("n_nationkey", "n_name", "r_name")


@query(
    "left_filtered_join",
    """
    SELECT c.c_custkey, o.n FROM customer c LEFT JOIN
      (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2) o
      ON o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P' AND o.n <= 3
    """,
)
def left_filtered_join(spark, sf):
    """Constant and range predicates of the right side inside a left join (JN-9)."""
    counts = table(spark, sf, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    wanted = counts.filter((F.col("o_orderstatus") == "P") & (F.col("n") <= 3))
    customer = table(spark, sf, "customer")
    return customer.join(wanted, customer.c_custkey == wanted.o_custkey, "left").select("c_custkey", "n")


@query(
    "chain_self_join",
    f"WITH {VERSIONS} SELECT a.o_custkey, a.o_orderkey, b.o_orderkey AS next_order FROM versions a "
    "JOIN versions b ON a.o_custkey = b.o_custkey AND a.enddate = b.effectivedate",
)
def chain_self_join(spark, sf):
    """End date of one version equals the start of the next (JN-13): an equality join on both columns."""
    v = customer_versions(spark, sf)
    nxt = v.select(
        F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("next_order"), F.col("effectivedate").alias("s")
    )
    on = (F.col("o_custkey") == F.col("k")) & (F.col("enddate") == F.col("s"))
    return v.join(nxt, on).select("o_custkey", "o_orderkey", "next_order")


# Spans of up to five weeks that start every few days, some nested, some empty.
SPANS = """SELECT row_number() OVER () AS r, l_suppkey, CAST(l_shipdate AS DATE) AS s,
    CAST(l_shipdate AS DATE) + CAST((l_orderkey * 7 + l_linenumber) % 35 AS INT) AS e FROM lineitem"""


@query(
    "overlap_counts",
    f"""WITH v AS ({SPANS})
    SELECT a.l_suppkey, count(b.r) AS pairs FROM v a LEFT JOIN v b
      ON a.l_suppkey = b.l_suppkey AND a.r <> b.r AND a.s >= b.s AND a.s < b.e GROUP BY 1""",
)
def overlap_counts(spark, sf):
    """Pairs of overlapping spans of each supplier, counted by signed events and not formed (JN-14, AUD-5)."""
    from brokerdw.operators import checks

    start = F.to_date("l_shipdate")
    width = ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 35).cast("int")
    spans = table(spark, sf, "lineitem").select("l_suppkey", start.alias("s"), F.date_add(start, width).alias("e"))
    return checks.overlap_counts(spans, ["l_suppkey"], "s", "e")


@query(
    "overlap_detection",
    """
    WITH v AS (SELECT l_suppkey, l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS s,
                      CAST(l_shipdate AS DATE) + CAST(l_quantity % 3 AS INT) AS e FROM lineitem)
    SELECT l_suppkey, count(*) > 0 AS overlaps FROM (
      SELECT l_suppkey, lead(s) OVER (PARTITION BY l_suppkey ORDER BY s, e) AS nxt, e FROM v)
    WHERE nxt < e GROUP BY 1
    """,
)
def overlap_detection(spark, sf):
    """Keys with overlapping intervals, found between neighbours instead of by a self range join (JN-14)."""
    from brokerdw.operators.checks import overlapping_versions

    day = F.to_date("l_shipdate")
    spans = table(spark, sf, "lineitem").select(
        "l_suppkey",
        day.alias("effectivedate"),
        F.date_add(day, (F.col("l_quantity") % 3).cast("int")).alias("enddate"),
    )
    return overlapping_versions(spans, ["l_suppkey"]).select("l_suppkey").distinct().withColumn("overlaps", F.lit(True))


@query(
    "theta_self_join",
    """
    WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT a.user_id, CAST(a.day AS VARCHAR) AS day, a.n,
           CAST(coalesce(max(CASE WHEN b.n < a.n THEN 1 ELSE 0 END), 0) AS BIGINT) AS drops_later
    FROM d a LEFT JOIN d b ON a.user_id = b.user_id AND b.day > a.day GROUP BY 1, 2, 3
    """,
)
def theta_self_join(spark, sf):
    """Whether any later count of the same source is smaller (JN-15).

    Daily counts leave one row per source and day; the smallest later count is a
    window value, so no pairs are formed.
    """
    from pyspark.sql import Window

    daily = table(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )
    later = Window.partitionBy("user_id").orderBy("day").rowsBetween(1, Window.unboundedFollowing)
    drops = F.coalesce(F.min("n").over(later) < F.col("n"), F.lit(False))
    return daily.select("user_id", "day", "n", drops.cast("bigint").alias("drops_later"))


@query(
    "or_on_join",
    """
    WITH w AS (SELECT o_orderkey % 3 AS b, min(CAST(o_orderdate AS DATE)) AS first_day,
                      max(CAST(o_orderdate AS DATE)) AS last_day FROM orders GROUP BY 1)
    SELECT o.o_orderkey FROM orders o JOIN w ON o.o_orderkey % 3 = w.b
      AND (CAST(o.o_orderdate AS DATE) = w.first_day OR CAST(o.o_orderdate AS DATE) = w.last_day)
    """,
)
def or_on_join(spark, sf):
    """Equality on the batch with an OR residual (JN-16)."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_orderkey") % 3).alias("b"), F.to_date("o_orderdate").alias("d")
    )
    window = orders.groupBy("b").agg(F.min("d").alias("first_day"), F.max("d").alias("last_day"))
    edge = (F.col("d") == F.col("first_day")) | (F.col("d") == F.col("last_day"))
    return orders.join(window, "b").filter(edge).select("o_orderkey")


@query(
    "one_row_side",
    "SELECT s_suppkey, s_acctbal / m.top AS share FROM supplier CROSS JOIN (SELECT max(s_acctbal) AS top FROM supplier) m",
)
def one_row_side(spark, sf):
    """A one-row side as a scalar subquery instead of a cross join (JN-18)."""
    supplier = table(spark, sf, "supplier")
    top = supplier.select(F.max("s_acctbal")).scalar()
    return supplier.select("s_suppkey", (F.col("s_acctbal") / top).alias("share"))


@query(
    "semi_in",
    "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
)
def semi_in(spark, sf):
    """IN-subquery as a left semi join (PRJ-9)."""
    urgent = table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    customer = table(spark, sf, "customer")
    return customer.join(urgent, customer.c_custkey == urgent.o_custkey, "left_semi").select("c_custkey")


@query(
    "star_join_count",
    """
    SELECT 'lineitem' AS messagesource, count(*) AS messagedata FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
    JOIN part p ON l.l_partkey = p.p_partkey JOIN nation n ON s.s_nationkey = n.n_nationkey
    """,
)
def star_join_count(spark, sf):
    line = table(spark, sf, "lineitem")
    joined = (
        line.join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return joined.agg(F.count(F.lit(1)).alias("messagedata")).select(F.lit("lineitem").alias("messagesource"), "messagedata")


@query(
    "left_group_having",
    """
    SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey
    GROUP BY c_custkey HAVING count(o_orderkey) < 10
    """,
)
def left_group_having(spark, sf):
    """Left join, group, having (JN-19): grouped first, so that only counts are joined."""
    counts = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("o_orderkey").alias("cnt"))
    customer = table(spark, sf, "customer")
    return (
        customer.join(counts, customer.c_custkey == counts.o_custkey, "left")
        .select("c_custkey", F.coalesce("cnt", F.lit(0)).alias("n"))
        .filter(F.col("n") < 10)
    )


@query("union_all", "SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def union_all(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")).unionByName(
        table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k"))
    )


@query("union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(spark, sf):
    return union_all(spark, sf).distinct()
