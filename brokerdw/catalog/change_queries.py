"""Keyed merges (MRG-1..7) and change-data-capture (STR-1..10)."""

from pyspark.sql import functions as F

from brokerdw.catalog.registry import query, table
from brokerdw.functions.exprs import smart_key
from brokerdw.operators import grouping, merge, temporal
from brokerdw.session import scratch_dir
from brokerdw.sources import scans
from brokerdw.sources.store import TableStore
from brokerdw.streaming import cdc

LATEST = """
    SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 2 = {n}
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1
"""


def _latest(spark, sf, n):
    orders = table(spark, sf, "orders").filter(F.col("o_orderkey") % 2 == n)
    return grouping.latest_record(orders, ["o_custkey"], ["o_orderkey"], ["o_orderkey", "o_totalprice"])


@query(
    "merge_scd1",
    f"""
    WITH t AS ({LATEST.format(n=0)}), s AS ({LATEST.format(n=1)})
    SELECT coalesce(t.o_custkey, s.o_custkey) AS o_custkey, coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
           CASE WHEN t.o_custkey IS NULL THEN s.o_totalprice
                WHEN s.o_custkey IS NULL OR t.o_totalprice >= 200000 THEN t.o_totalprice
                WHEN s.o_totalprice > 100000 THEN s.o_totalprice ELSE 0 END AS o_totalprice
    FROM t FULL OUTER JOIN s ON t.o_custkey = s.o_custkey
    """,
)
def merge_scd1(spark, sf):
    """Update on match by clause, insert otherwise (MRG-0, MRG-3)."""
    return _by_clause(_latest(spark, sf, 0), _latest(spark, sf, 1))


def _by_clause(target, source):
    cheap = F.col("t_o_totalprice") < 200000
    matched = [
        (cheap & (F.col("s_o_totalprice") > 100000), {"o_totalprice": F.col("s_o_totalprice")}),
        (cheap, {"o_totalprice": F.lit(0.0)}),
    ]
    return merge.merge(target, source, ["o_custkey"], matched=matched)


@query(
    "merge_open_rows",
    f"""
    WITH t AS ({LATEST.format(n=0)}), s AS ({LATEST.format(n=1)})
    SELECT t.o_custkey, t.o_orderkey, CASE WHEN s.o_custkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice
    FROM t LEFT JOIN s ON t.o_custkey = s.o_custkey AND t.o_orderkey % 4 = 0
    UNION ALL
    SELECT s.o_custkey, s.o_orderkey, s.o_totalprice FROM s
    WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_custkey = s.o_custkey AND t.o_orderkey % 4 = 0)
    """,
)
def merge_open_rows(spark, sf):
    """Only eligible (open) target rows match; other source rows are inserted (MRG-3)."""
    return merge.merge(
        _latest(spark, sf, 0),
        _latest(spark, sf, 1),
        ["o_custkey"],
        matched=[(None, {"o_totalprice": F.col("s_o_totalprice")})],
        eligible=F.col("t_o_orderkey") % 4 == 0,
    )


HISTORY = """
    hist AS (
      SELECT o_custkey, o_orderpriority, effectivedate,
             coalesce(lead(effectivedate) OVER (PARTITION BY o_custkey ORDER BY effectivedate), DATE '9999-12-31') AS enddate
      FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS effectivedate, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority
            FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1, 2)),
    chg AS (
      SELECT o_custkey, DATE '2002-01-01' AS effectivedate,
             arg_max(CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE o_orderpriority END, o_orderkey) AS raw
      FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1)
"""
TAIL = """CAST(strftime(effectivedate, '%Y%m%d') || CAST(o_custkey AS VARCHAR) AS BIGINT) AS sk, o_custkey,
          o_orderpriority, CAST(effectivedate AS VARCHAR) AS effectivedate, CAST(enddate AS VARCHAR) AS enddate, iscurrent"""


def _history(spark, sf):
    orders = table(spark, sf, "orders").filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    daily = orders.groupBy("o_custkey", F.to_date("o_orderdate").alias("effectivedate")).agg(
        F.max_by("o_orderpriority", "o_orderkey").alias("o_orderpriority")
    )
    hist = temporal.close_open_versions(daily, "o_custkey")
    return hist.select(
        smart_key("effectivedate", "o_custkey").alias("sk"),
        "o_custkey",
        "o_orderpriority",
        "effectivedate",
        "enddate",
        "iscurrent",
    )


def _changes(spark, sf):
    late = table(spark, sf, "orders").filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    raw = F.when(F.col("o_orderkey") % 2 == 0, "").otherwise(F.col("o_orderpriority"))
    return late.groupBy("o_custkey").agg(F.nullif(F.max_by(raw, "o_orderkey"), F.lit("")).alias("o_orderpriority")).select(
        "o_custkey", "o_orderpriority", F.lit("2002-01-01").cast("date").alias("effectivedate")
    )


def _scd2_sql(priority):
    return f"""
    WITH {HISTORY},
    closed AS (
      SELECT h.o_custkey, h.o_orderpriority, h.effectivedate,
             CASE WHEN h.enddate = DATE '9999-12-31' AND c.o_custkey IS NOT NULL THEN c.effectivedate ELSE h.enddate END AS enddate,
             h.enddate = DATE '9999-12-31' AND c.o_custkey IS NULL AS iscurrent
      FROM hist h LEFT JOIN chg c ON h.o_custkey = c.o_custkey),
    opened AS (
      SELECT c.o_custkey, {priority} AS o_orderpriority, c.effectivedate, DATE '9999-12-31' AS enddate, TRUE AS iscurrent
      FROM chg c LEFT JOIN hist h ON h.o_custkey = c.o_custkey AND h.enddate = DATE '9999-12-31')
    SELECT {TAIL} FROM closed UNION ALL SELECT {TAIL} FROM opened
    """


def _merged(spark, sf, **options):
    return merge.scd2_merge(
        _history(spark, sf), _changes(spark, sf), ["o_custkey"], surrogate=("sk", "o_custkey"), **options
    )


@query("merge_scd2", _scd2_sql("nullif(c.raw, '')"))
def merge_scd2(spark, sf):
    """Close the current version, open a new one (MRG-1)."""
    return _merged(spark, sf).with_history(_history(spark, sf).filter(~F.col("iscurrent")))


def _by_bucket(spark, rows, keys, final=None):
    """A table ``dim`` laid out by eight buckets of its keys."""
    store = TableStore(spark, scratch_dir(spark, "merge-buckets"))
    store.replace_buckets("dim", rows, keys, store.buckets_of(rows, keys, 8), "first", 8, final)
    return store


@query(
    "merge_scd1_buckets",
    f"""
    WITH t AS ({LATEST.format(n=0)}), s AS ({LATEST.format(n=1)})
    SELECT coalesce(t.o_custkey, s.o_custkey) AS o_custkey, coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
           CASE WHEN t.o_custkey IS NULL THEN s.o_totalprice
                WHEN s.o_custkey IS NULL OR t.o_totalprice >= 200000 THEN t.o_totalprice
                WHEN s.o_totalprice > 100000 THEN s.o_totalprice ELSE 0 END AS o_totalprice
    FROM t FULL OUTER JOIN s ON t.o_custkey = s.o_custkey
    """,
)
def merge_scd1_buckets(spark, sf):
    """The merge in three batches into a table laid out by key; a batch reads and writes the buckets of its keys."""
    store, source = _by_bucket(spark, _latest(spark, sf, 0), ["o_custkey"]), _latest(spark, sf, 1)
    for n in range(3):
        batch = source.filter(F.col("o_custkey") % 3 == n)
        store.update_buckets("dim", batch, ["o_custkey"], _by_clause, f"batch-{n}", 8)
    return store.read("dim")


@query("merge_scd2_buckets", _scd2_sql("nullif(c.raw, '')"))
def merge_scd2_buckets(spark, sf):
    """Current versions laid out by key; a batch replaces those it touches and adds the versions it ends (MRG-1, SNK-4)."""
    history, ended = _history(spark, sf), ~F.col("iscurrent")
    store = _by_bucket(spark, history, ["o_custkey"], ended)

    def plan(current, changes):
        return merge.scd2_merge(current, changes, ["o_custkey"], surrogate=("sk", "o_custkey")).rows

    return store.update_buckets("dim", _changes(spark, sf), ["o_custkey"], plan, "batch", 8, ended)


@query("merge_coalesce", _scd2_sql("coalesce(nullif(c.raw, ''), h.o_orderpriority)"))
def merge_coalesce(spark, sf):
    """Null incoming values keep the previous version's (MRG-6); stored copy-on-write by current flag."""
    store = TableStore(spark, scratch_dir(spark, "scd2"))
    base = store.write_scd2("dim", _history(spark, sf))
    merged = merge.scd2_merge(
        base, _changes(spark, sf), ["o_custkey"], ["o_orderpriority"], surrogate=("sk", "o_custkey")
    )
    return store.merge_scd2("dim", merged)


@query(
    "merge_hybrid",
    _scd2_sql("coalesce(nullif(c.raw, ''), h.o_orderpriority)")
    .replace(
        "SELECT h.o_custkey, h.o_orderpriority, h.effectivedate,",
        "SELECT h.o_custkey, CASE WHEN h.enddate = DATE '9999-12-31' AND c.o_custkey IS NULL AND h.o_custkey % 3 = 0 "
        "THEN 'OVERWRITTEN' ELSE h.o_orderpriority END AS o_orderpriority, h.effectivedate,",
    ),
)
def merge_hybrid(spark, sf):
    """Type 2 changes and in-place overwrites of otherwise unchanged current rows (MRG-2)."""
    inplace = table(spark, sf, "customer").filter(F.col("c_custkey") % 3 == 0).select(
        F.col("c_custkey").alias("o_custkey"), F.lit("OVERWRITTEN").alias("o_orderpriority")
    )
    merged = _merged(
        spark, sf, coalesce_cols=["o_orderpriority"], inplace=inplace, inplace_cols=["o_orderpriority"]
    )
    return merged.with_history(_history(spark, sf).filter(~F.col("iscurrent")))


@query(
    "merge_propagate",
    f"""
    WITH {HISTORY}
    SELECT h.o_custkey * 10 + 1 AS accountid, CAST('20020101' || CAST(h.o_custkey AS VARCHAR) AS BIGINT) AS sk_customerid,
           '2002-01-01' AS effectivedate
    FROM hist h JOIN chg c ON h.o_custkey = c.o_custkey WHERE h.enddate = DATE '9999-12-31'
    """,
)
def merge_propagate(spark, sf):
    """A new parent version forces a new version of each current child (MRG-5)."""
    merged = _merged(spark, sf)
    accounts = _history(spark, sf).filter("iscurrent").select(
        (F.col("o_custkey") * 10 + 1).alias("accountid"),
        F.col("sk").alias("sk_customerid"),
        "effectivedate",
        "iscurrent",
    )
    opened = merged.current.filter(F.col("effectivedate") == F.lit("2002-01-01").cast("date"))
    moved = merge.propagate_versions(
        accounts,
        merged.closed.withColumnRenamed("sk", "sk_customerid"),
        opened.withColumnRenamed("sk", "sk_customerid"),
        "o_custkey",
        "sk_customerid",
    )
    return moved.drop("iscurrent")


@query(
    "merge_by_surrogate",
    """
    WITH cust AS (SELECT c_custkey, c_custkey * 100 + 7 AS sk FROM customer),
    open AS (SELECT sk AS sk_customerid, min(o_orderkey) AS placed FROM orders JOIN cust ON o_custkey = c_custkey
             WHERE o_orderkey % 2 = 0 GROUP BY 1),
    w AS (SELECT o_custkey, min(CASE WHEN o_orderstatus <> 'F' THEN o_orderkey END) AS placed,
                 max(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS removed
          FROM orders WHERE o_orderkey % 2 = 1 GROUP BY 1)
    SELECT o.sk_customerid, o.placed, CASE WHEN w.placed IS NULL THEN w.removed END AS removed
    FROM open o JOIN cust c ON c.sk = o.sk_customerid LEFT JOIN w ON w.o_custkey = c.c_custkey
    UNION ALL
    SELECT c.sk, w.placed, w.removed FROM w JOIN cust c ON w.o_custkey = c.c_custkey WHERE w.placed IS NOT NULL
    """,
)
def merge_by_surrogate(spark, sf):
    """Cancellations are resolved to open rows through the dimension, then merged (MRG-4)."""
    customer = table(spark, sf, "customer").select("c_custkey", (F.col("c_custkey") * 100 + 7).alias("sk_customerid"))
    orders = table(spark, sf, "orders")
    first = orders.filter(F.col("o_orderkey") % 2 == 0).groupBy("o_custkey").agg(F.min("o_orderkey").alias("placed"))
    target = first.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "sk_customerid", "placed", F.lit(None).cast("bigint").alias("removed")
    )
    batch = grouping.placed_removed(
        orders.filter(F.col("o_orderkey") % 2 == 1), ["o_custkey"], "o_orderkey", "o_orderstatus", "F"
    ).join(customer, F.col("o_custkey") == F.col("c_custkey"))
    cancels = batch.filter(F.col("placed").isNull()).select("sk_customerid", "placed", "removed")
    closed = merge.merge(
        target,
        cancels,
        ["sk_customerid"],
        matched=[(None, {"removed": F.col("s_removed")})],
        insert=False,
        eligible=F.col("t_removed").isNull(),
    )
    placements = batch.filter(F.col("placed").isNotNull()).select("sk_customerid", "placed", "removed")
    return closed.unionByName(placements)


# -- change data capture --------------------------------------------------------
EVENT_SCHEMA = "event_id BIGINT, user_id BIGINT, seq TIMESTAMP, event_type STRING, value DOUBLE"
MISSING = "CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END"


def _event_changes(spark, sf):
    """Events as change rows of their user; type and value are missing now and then."""
    key = F.col("event_id")
    return table(spark, sf, "events").select(
        "event_id",
        "user_id",
        F.col("ts").cast("timestamp").alias("seq"),
        F.when(key % 4 != 0, F.col("event_type")).alias("event_type"),
        F.when(key % 3 != 0, F.col("value")).alias("value"),
    )


def _stream_files(spark, sf, root):
    """Three loads whose rows are out of time order, so that late rows reach old intervals.

    A micro-batch takes as many files as a load wrote. With one file each, their number would grow
    with the tables, and every one of them touches all buckets of a log laid out by key.
    """
    changes = _event_changes(spark, sf)
    for n in range(3):
        third = changes.filter(F.col("event_id") % 3 == (n + 1) % 3)
        writer = third.write.mode("append").option("sep", "|")
        writer.option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(f"{root}/in")
    files = len(spark.read.text(f"{root}/in", pathGlobFilter=FILES).inputFiles())
    return scans.stream_delimited(spark, f"{root}/in", EVENT_SCHEMA, "|", FILES, max_files=max(1, -(-files // 3)))


FILES = "part-*"
SCD1 = f"""
    SELECT user_id, arg_max({MISSING}, ts) FILTER (WHERE event_id % 4 <> 0) AS event_type,
           arg_max(value, ts) FILTER (WHERE event_id % 3 <> 0) AS value
    FROM events GROUP BY 1
"""


@query("cdc_scd1", SCD1)
def cdc_scd1(spark, sf):
    """Automatic type 1 changes from a file stream, nulls ignored, rows out of order."""
    root = scratch_dir(spark, "cdc1")
    store = TableStore(spark, root)
    to_log = lambda df: cdc.scd1_log(df, ["user_id"], "seq", True, ["event_id", "seq"])
    cdc.run_cdc(_stream_files(spark, sf, root), store, "state", to_log, f"{root}/checkpoint")
    return cdc.scd1_view(store.read("state"), ["user_id"])


@query("cdc_scd1_batches", SCD1)
def cdc_scd1_batches(spark, sf):
    """The batch form: state folded with two later batches, one of them older (STR-2, 4, 5)."""
    changes = _event_changes(spark, sf)
    state = None
    for n in (1, 2, 0):
        part = changes.filter(F.col("event_id") % 3 == n)
        state = cdc.apply_changes_scd1(state, part, ["user_id"], "seq", True, ["event_id", "seq"])
    return cdc.scd1_view(state, ["user_id"])


SCD2 = f"""
    WITH f AS (
      SELECT user_id, ts, lead(ts) OVER w AS nxt,
             last_value({MISSING} IGNORE NULLS) OVER w AS event_type,
             last_value(CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END IGNORE NULLS) OVER w AS value
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))
    SELECT user_id, CAST(strftime(ts, '%Y%m%d%H%M%S') AS BIGINT) AS start_at,
           CAST(strftime(nxt, '%Y%m%d%H%M%S') AS BIGINT) AS end_at, event_type, value,
           CAST(CAST(ts AS DATE) AS VARCHAR) AS effectivedate,
           CAST(coalesce(CAST(nxt AS DATE), DATE '9999-12-31') AS VARCHAR) AS enddate, nxt IS NULL AS iscurrent
    FROM f
"""


def _show_history(history):
    stamp = lambda c: F.date_format(c, "yyyyMMddHHmmss").cast("bigint")
    return cdc.with_validity(history).select(
        "user_id",
        stamp("__START_AT").alias("start_at"),
        stamp("__END_AT").alias("end_at"),
        "event_type",
        "value",
        "effectivedate",
        "enddate",
        "iscurrent",
    )


@query("cdc_scd2", SCD2)
def cdc_scd2(spark, sf):
    """Automatic type 2 changes: one-time hydration, then a stream of late rows (STR-3..7)."""
    root = scratch_dir(spark, "cdc2")
    store = TableStore(spark, root)
    to_log = lambda df: cdc.scd2_log(df, ["user_id"], "seq", ["event_id"])
    once = _event_changes(spark, sf).filter(F.col("event_id") % 5 == 0)
    cdc.run_cdc(_stream_files(spark, sf, root), store, "log", to_log, f"{root}/checkpoint", once=once)
    return _show_history(cdc.scd2_view(store.read("log"), ["user_id"]))


@query("cdc_scd1_buckets", SCD1)
def cdc_scd1_buckets(spark, sf):
    """Type 1 changes in a log laid out by key: a micro-batch folds the buckets it touches, the view is read as it is."""
    root = scratch_dir(spark, "cdc1-buckets")
    store = TableStore(spark, root)
    to_log = lambda df: cdc.scd1_log(df, ["user_id"], "seq", True, ["event_id", "seq"])
    by = cdc.ByKey(["user_id"], cdc.combine_scd1, cdc.scd1_view, 8)
    cdc.run_cdc(_stream_files(spark, sf, root), store, "state", to_log, f"{root}/checkpoint", by=by)
    return store.read("state_view")


@query("cdc_scd2_buckets", SCD2)
def cdc_scd2_buckets(spark, sf):
    """Type 2 changes in a log laid out by key: a micro-batch sequences the buckets it touches again."""
    root = scratch_dir(spark, "cdc2-buckets")
    store = TableStore(spark, root)
    to_log = lambda df: cdc.scd2_log(df, ["user_id"], "seq", ["event_id"])
    once = _event_changes(spark, sf).filter(F.col("event_id") % 5 == 0)
    by = cdc.ByKey(["user_id"], cdc.combine_scd2, cdc.scd2_view, 8)
    cdc.run_cdc(_stream_files(spark, sf, root), store, "log", to_log, f"{root}/checkpoint", once=once, by=by)
    return _show_history(store.read("log_view"))


@query("cdc_out_of_order", SCD2)
def cdc_out_of_order(spark, sf):
    """The batch form, newest rows first: late rows split the intervals they fall into."""
    changes = _event_changes(spark, sf)
    state = None
    for n in (2, 0, 1):
        part = changes.filter(F.col("event_id") % 3 == n)
        state = cdc.apply_changes_scd2(state, part, ["user_id"], "seq", ["event_id"])
    return _show_history(cdc.scd2_view(state, ["user_id"]))


@query(
    "stream_static_join",
    """
    SELECT e.event_id, CASE WHEN event_type IN ('purchase', 'error') THEN NULL ELSE event_id END AS created,
           CASE WHEN event_type IN ('purchase', 'error') THEN event_id END AS closed, h.first_id
    FROM (SELECT event_id, user_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END AS event_type FROM events) e
    JOIN (SELECT user_id, min(event_id) AS first_id FROM events GROUP BY 1) h ON e.user_id = h.user_id
    """,
)
def stream_static_join(spark, sf):
    """A stream normalised and joined to a static aggregate, written as it arrives (STR-1, 8, 9, JN-20)."""
    root = scratch_dir(spark, "static")
    first = table(spark, sf, "events").groupBy("user_id").agg(F.min("event_id").alias("first_id"))
    closing = F.coalesce(F.col("event_type").isin("purchase", "error"), F.lit(False))
    stream = _stream_files(spark, sf, root).join(first, "user_id").select(
        "event_id",
        F.when(~closing, F.col("event_id")).alias("created"),
        F.when(closing, F.col("event_id")).alias("closed"),
        "first_id",
    )
    store = TableStore(spark, root)
    cdc.run_cdc(stream, store, "joined", lambda df: df, f"{root}/checkpoint")
    return store.read("joined")


@query(
    "cdc_full_refresh",
    SCD1,
)
def cdc_full_refresh(spark, sf):
    """A refresh loads the same files into a new table with a new checkpoint (STR-10)."""
    root = scratch_dir(spark, "refresh")
    store = TableStore(spark, root)
    to_log = lambda df: cdc.scd1_log(df, ["user_id"], "seq", True, ["event_id", "seq"])
    stream = _stream_files(spark, sf, root)
    cdc.run_cdc(stream, store, "state", to_log, f"{root}/checkpoint1")
    store.write("state", store.read("state").limit(0), flow="refresh")
    cdc.run_cdc(stream, store, "state", to_log, f"{root}/checkpoint2", flow="stream2")
    folded = store.compact("state", lambda df: cdc.combine_scd1(df, ["user_id"]))
    return cdc.scd1_view(folded, ["user_id"])
