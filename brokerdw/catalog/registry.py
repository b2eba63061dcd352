"""Registry of queries and of the SQL that computes the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; results show dates as text so that both engines agree on them."""

    def add(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: printable(fn(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def printable(df: DataFrame) -> DataFrame:
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    return df.withColumns({c: F.col(c).cast("string") for c in dates}) if dates else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
