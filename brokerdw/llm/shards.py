"""Proportional stratified interleaving: every shard holds the sources in the corpus mixture.

Rows of a source are ranked in a seeded shuffle; (rank + 1/2) / rows of the source is the
fractional rank. Sorting all rows by it interleaves the sources evenly, and the sorted rows
are cut into shards whose row counts differ by one at most.

Nulls: null sources form one source; a null text has no bytes; null ids are shuffled like
others. Repeated rows take separate slots. An empty table gives no rows. Extra columns are
not read. Of a text, however long, only size and checksum are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brokerdw.llm.common import BEFORE, WHOLE, group_key, sums_before

SHARDS = 16
SEED = "shard-1"
# Cells of the fractional rank; their counts are summed up in one small task.
CELLS = 4_096


def assign_shards(docs: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """Per row: doc_id, size (bytes + 1), text_crc32, law, shard, slot, grown_shard (null: the law is ``rows``)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        group_key("source").alias("_g"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("_key"),
        F.lit(1).cast("long").alias("_one"),
    ).withColumn("_cell", F.substring("_key", 1, 3))
    ties = ["_key", "text_crc32", "size"]
    ranked = sums_before(rows, ["_g"], "_cell", ties, "_one").drop("_cell")
    spread = ranked.withColumn("_part", (F.col(BEFORE) + 0.5) / F.col(WHOLE)).drop(BEFORE, WHOLE)
    spread = spread.withColumn("_cell", F.floor(F.col("_part") * CELLS).cast("int")).withColumn("_all", F.lit(0))
    placed = sums_before(spread, ["_all"], "_cell", ["_part", "_g", *ties], "_one")
    exact = placed.withColumn("shard", F.expr(f"cast({BEFORE} * {shards} div {WHOLE} as int)"))
    start = F.expr(f"(shard * {WHOLE} + {shards} - 1) div {shards}")
    return exact.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col(BEFORE) - start).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
