"""Data-quality operators (DQ-5..7) on the given tables."""

from pyspark.sql import functions as F

from brokerdw.catalog.registry import query, table
from brokerdw.operators import checks


@query("check_unique", "SELECT l_orderkey, l_partkey, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def check_unique(spark, sf):
    return checks.check_unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey"])


@query(
    "check_fk",
    """
    SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')
    """,
)
def check_fk(spark, sf):
    parent = table(spark, sf, "orders").filter(F.col("o_orderstatus") != "P")
    return checks.check_fk(table(spark, sf, "lineitem"), parent, [("l_orderkey", "o_orderkey")]).select(
        "l_orderkey", "l_linenumber"
    )


LOST = "CASE WHEN l_orderkey % 97 = 5 AND l_linenumber = 1 THEN -l_orderkey WHEN l_orderkey % 101 = 7 THEN NULL ELSE l_orderkey END"


@query(
    "check_fk_orphans",
    f"""
    WITH c AS (SELECT {LOST} AS ref, l_partkey, l_linenumber FROM lineitem)
    SELECT ref, l_partkey, l_linenumber FROM c WHERE ref IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = ref)
    """,
)
def check_fk_orphans(spark, sf):
    """A few references are made to lead nowhere, some are null: a sketch of the lost keys finds the rows (DQ-6)."""
    child = table(spark, sf, "lineitem").select(F.expr(LOST).alias("ref"), "l_partkey", "l_linenumber")
    return checks.check_fk(child, table(spark, sf, "orders"), [("ref", "o_orderkey")])


@query(
    "expectations",
    """
    SELECT 'known_flag' AS rule, count(*) FILTER (WHERE l_returnflag IN ('A','R')) AS passed,
           count(*) FILTER (WHERE NOT l_returnflag IN ('A','R')) AS failed FROM lineitem
    UNION ALL
    SELECT 'tax_small', count(*) FILTER (WHERE l_tax <= l_discount), count(*) FILTER (WHERE l_tax > l_discount) FROM lineitem
    """,
)
def expectations(spark, sf):
    rules = {
        "known_flag": F.col("l_returnflag").isin("A", "R"),
        "tax_small": F.col("l_tax") <= F.col("l_discount"),
    }
    return checks.expect(table(spark, sf, "lineitem"), rules)
