"""Tables written to the scratch folder."""

from pyspark.sql import functions as F

from brokerdw.llm.common import stored
from brokerdw.session import SHUFFLE_CLEANUP


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle")}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    sums = spark.range(1000).groupBy((F.col("id") % 97).alias("k")).agg(F.sum("id").alias("s"))
    out = stored(sums, "sums")
    assert not shuffle_files(spark) - before
    # The frame can still be used, and the setting is what it was.
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, sums.collect()))
    assert spark.conf.get(SHUFFLE_CLEANUP, "false") == "false"
