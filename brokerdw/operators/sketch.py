"""Bloom sketches of key sets, built by aggregation and sized by the counted keys.

A sketch is one row: an array of 64-bit words. A key sets ``HASHES`` bits, so a row whose bits
are not all set has a key that is surely not in the set; about one in 300 other rows passes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, HASHES = 12, 6  # bits a key, and bits that a key sets
# A sketch has so many words at most (2 MB); a larger set is joined like any table.
MOST_WORDS = 1 << 18


def words_for(count: int) -> int | None:
    """Words of a sketch of ``count`` keys, a power of two; None if it would be too large."""
    words = 1 << max(0, (count * BITS - 1) // 64).bit_length()
    return words if words <= MOST_WORDS else None


def _places(keys: Sequence[Column], words: int) -> Column:
    """The numbers of the bits of a key, by double hashing."""
    one, two = F.xxhash64(*keys), F.xxhash64(F.lit(7), *keys)
    return F.array(*[(F.pmod(one, F.lit(1 << 40)) + i * F.pmod(two, F.lit(1 << 40))) % (words * 64) for i in range(HASHES)])


def bloom(keys: DataFrame, words: int) -> DataFrame:
    """One row with the array ``bits`` for all columns of ``keys``, combined before the shuffle."""
    place = keys.select(F.explode(_places([F.col(c) for c in keys.columns], words)).alias("p"))
    bit = F.expr("shiftleft(1L, cast(p & 63 as int))")
    filled = place.groupBy(F.shiftright("p", 6).alias("i")).agg(F.bit_or(bit).alias("v"))
    slots = keys.sparkSession.range(0, words, 1, 1).withColumnRenamed("id", "i")
    whole = slots.join(filled, "i", "left").select("i", F.coalesce("v", F.lit(0).cast("long")).alias("v"))
    listed = whole.agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("s"))  # ``words`` entries
    return listed.select(F.transform("s", lambda x: x["v"]).alias("bits"))


def may_hold(df: DataFrame, on: Sequence[str], keys: DataFrame, words: int) -> DataFrame:
    """The rows of ``df`` whose ``on`` columns may be among ``keys``; no row is shuffled."""
    tested = df.withColumn("_bits", bloom(keys, words).scalar())
    places = _places([F.col(c) for c in on], words)
    hit = lambda p: F.get("_bits", F.shiftright(p, 6).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (p % 64).cast("int"))) != 0
    found = hit(F.get(places, F.lit(0)))
    for i in range(1, HASHES):
        found = found & hit(F.get(places, F.lit(i)))
    return tested.filter(found).drop("_bits")
