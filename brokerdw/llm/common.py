"""Shared helpers of the training-data operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brokerdw.session import scratch_dir, write_parquet

BEFORE, WHOLE = "_before", "_whole"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def group_key(column: str) -> Column:
    """Text that is equal for equal values and for nulls, and different otherwise."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def sums_before(
    df: DataFrame, group: Sequence[str], cell: str, order: Sequence[Column | str], value: str
) -> DataFrame:
    """Add ``_before``, the sum of ``value`` over the group's earlier rows, and ``_whole``, over all of them.

    ``cell`` is a column that grows with the order and cuts a group into a bounded number
    of parts: rows are summed per (group, cell), the sums of earlier cells are added. No
    group is sorted in one task, however large.
    """
    sums = df.groupBy(*group, cell).agg(F.sum(value).alias("_cell_sum"))
    earlier = Window.partitionBy(*group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *group,
        cell,
        F.coalesce(F.sum("_cell_sum").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_cell_sum").over(Window.partitionBy(*group)).alias(WHOLE),
    )
    inside = Window.partitionBy(*group, cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = local.join(offsets, [*group, cell])
    return joined.withColumn(BEFORE, F.col("_offset") + F.col("_local")).drop("_offset", "_local")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once a session, as ``spark-submit --py-files`` would."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    root = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="brokerdw-code-")  # read by the driver alone, until it ends
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    target = Path(folder) / "brokerdw.zip"
    with zipfile.ZipFile(target, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))


_SHIPPED: set[str] = set()


def numbered(df: DataFrame, order: Sequence[Column], out: str, name: str) -> DataFrame:
    """``df`` with ``out``, the row's number from 1 in a total order, without sorting all rows in one task.

    Rows are dealt to ranges of the order and stored with the number of their range; a
    number is the row's place in its range after the sizes of the ranges before it.
    """
    dealt = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    dealt = stored(dealt, name)
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))  # one row a range
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    placed = dealt.withColumn("_place", place).join(F.broadcast(starts), "_part")
    return placed.withColumn(out, F.col("_start") + F.col("_place")).drop("_part", "_place", "_start")
