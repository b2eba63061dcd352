"""Files of a table clustered by two columns cover small ranges of both."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from brokerdw.sources import clustering
from brokerdw.sources.store import TableStore


@pytest.fixture
def facts(spark):
    n = F.col("id")
    day = F.date_add(F.lit("2015-01-01").cast("date"), (F.pmod(F.xxhash64(n), F.lit(1000))).cast("int"))
    key = F.when(n % 50 > 0, F.pmod(F.xxhash64(n, F.lit(1)), F.lit(5000)))
    return spark.range(60_000).select(day.alias("d"), key.alias("k"), n.alias("v"))


def share_read(path, column, low, high):
    """Share of the files whose statistics don't rule out a value in the range."""
    files = [pq.ParquetFile(f) for f in Path(path).glob("*.parquet")]
    hits = 0
    for f in files:
        at = f.schema_arrow.get_field_index(column)
        stats = [f.metadata.row_group(g).column(at).statistics for g in range(f.num_row_groups)]
        hits += any(s.has_min_max and s.min <= high and s.max >= low for s in stats)
    return hits / len(files)


def test_either_column_skips_files(spark, facts, tmp_path):
    store = TableStore(spark, str(tmp_path))
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        both = store.write_part("both", facts, cluster_by=["d", "k"])
        one = store.write_part("one", facts.repartitionByRange("d", "k").sortWithinPartitions("d", "k"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    from datetime import date

    day = (date(2016, 5, 1), date(2016, 5, 1))
    assert share_read(one["path"], "k", 777, 777) > 0.9  # sorted by day first, each file holds keys of all sizes
    assert share_read(both["path"], "k", 777, 777) < 0.3
    assert share_read(both["path"], "d", *day) < 0.3
    rows = spark.read.parquet(both["path"])
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted(map(tuple, facts.collect()), key=repr)


def test_ranks_follow_the_values(spark):
    df = spark.createDataFrame([(i,) for i in range(1000)] + [(None,)], "x long")
    edges = clustering.rank_edges(df, ["x"])[0]
    got = df.select("x", clustering.rank(F.col("x"), edges).alias("r")).collect()
    assert all(r["r"] == (0 if r["x"] is None else sum(e <= r["x"] for e in edges)) for r in got)
    assert len({r["r"] for r in got}) == 1 << clustering.BITS


def test_bits_are_interleaved(spark):
    z = spark.range(1).select(clustering.interleaved([F.lit(0b11), F.lit(0b01)]).alias("z")).first()["z"]
    assert z == 0b1011


def test_empty_and_constant_columns(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    same = spark.range(100).select(F.lit(5).alias("a"), F.lit(None).cast("date").alias("b"))
    assert store.write("same", same, cluster_by=["a", "b"]).count() == 100
    assert store.write("none", same.limit(0), cluster_by=["a", "b"]).count() == 0
