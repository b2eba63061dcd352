"""Mixing sources to target weights by distributed prefix sums over a hash-random order.

Nulls: a null text has no words; null sources form one source, last in order; a null
doc_id is shuffled like any other. Repeated rows are mixed one by one. An empty table, or
one without words, gives targets of 0. Extra columns are left out of ``mix`` and kept by
``mixed_documents``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brokerdw.llm.common import BEFORE, group_key, stored, sums_before

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
CELLS = 4_096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets per source from ``_g, source, source_size`` (one row per source).

    Sources in code point order, null last, weigh ``weights`` in turn and share the whole
    size; a target above ``max_epochs`` times its source stops there and the rest is
    shared again by weight. With sources ordered by (limit / weight) the stopped ones are
    a prefix, so one pass of running sums finds them. The window holds one row per source.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (turn + 1).cast("int"))
    limit = F.col("source_size") * max_epochs
    ratio = F.col("_limit").cast("double") / F.col("_weight")
    order = Window.orderBy("_ratio", "_g")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.col("_total") - F.col("_limits_before")).cast("double") / (F.col("_weights") - F.col("_weights_before"))
    return (
        sizes.select("_g", "source", "source_size", weight.alias("_weight"), limit.alias("_limit"))
        .withColumn("_ratio", ratio)
        .withColumns(
            {
                "_total": F.sum("source_size").over(whole),
                "_weights": F.sum("_weight").over(whole),
                "_limits_before": F.coalesce(F.sum("_limit").over(earlier), F.lit(0)),
                "_weights_before": F.coalesce(F.sum("_weight").over(earlier), F.lit(0)),
            }
        )
        .withColumn("_level", level)
        .withColumn("_stops", F.col("_ratio") <= F.col("_level"))
        .withColumn("_final", F.min(F.when(~F.col("_stops"), F.struct("_ratio", "_g", "_level"))).over(whole)["_level"])
        .withColumn(
            "target",
            F.when(F.col("_stops"), F.col("_limit").cast("double")).otherwise(F.col("_final") * F.col("_weight")),
        )
        .select("_g", "source_size", "target")
    )


def _taken(rows: DataFrame, weights: tuple[int, ...], max_epochs: int, seed: str, whole: bool) -> DataFrame:
    """Add ``source_size, target, taken`` to rows of ``_row, _g, source, _id, _size, _tie``."""
    sizes = rows.groupBy("_g").agg(F.first("source").alias("source"), F.sum("_size").alias("source_size"))
    targets = source_targets(sizes, weights, max_epochs)
    keyed = rows.withColumn("_key", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit("")))))
    keyed = keyed.withColumn("_cell", F.substring("_key", 1, 3))
    placed = sums_before(keyed, ["_g"], "_cell", ["_key", "_tie"], "_size").join(targets, "_g")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.floor(F.col("target") - F.col("_epochs") * F.col("source_size")).cast("long")
    left = F.col("_rest") - F.col(BEFORE)
    if whole:  # the document at the cut is taken if at least half of it lies within the budget
        extra = F.when(left * 2 >= F.greatest("_size", F.lit(1)), F.col("_size")).otherwise(F.lit(0))
    else:
        extra = F.greatest(F.lit(0), F.least(left, F.col("_size")))
    placed = placed.withColumn("_epochs", epochs).withColumn("_rest", rest).withColumn("_extra", extra.cast("long"))
    return placed.withColumn("taken", F.col("_epochs") * F.col("_size") + F.col("_extra"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words; repeats counted).

    The last document of a source's budget is cut, so that the words taken are exactly
    the whole part of the target.
    """
    rows = docs.select(
        F.col("doc_id").alias("_id"),
        F.col("source").cast("string").alias("source"),
        group_key("source").alias("_g"),
        word_count(F.col("text")).alias("_size"),
        F.xxhash64("text").alias("_tie"),
    )
    out = _taken(rows, weights, max_epochs, seed, whole=False)
    return out.select(F.col("_id").alias("doc_id"), F.col("_size").alias("size"), "source_size", "target", "taken")


def mixed_documents(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """The mixed rows themselves: each document as often as the mix takes it, whole, with all columns.

    Documents without words stay once. Copies of a row are separate rows with the same doc_id.
    """
    rows = docs.select(
        F.struct("*").alias("_row"),
        F.col("doc_id").alias("_id"),
        F.col("source").cast("string").alias("source"),
        group_key("source").alias("_g"),
        word_count(F.col("text")).alias("_size"),
        F.xxhash64("text").alias("_tie"),
    )
    decided = _taken(rows.drop("_row"), weights, max_epochs, seed, whole=True)
    times = F.when(F.col("_size") > 0, F.floor(F.col("taken") / F.col("_size"))).otherwise(1).cast("int")
    # Repeated rows stand side by side in the order of the mix, so their counts fall once at
    # most: of ``_n`` rows of an id and text the first ``_more`` come ``_most`` times.
    same = ["_g", "_id", "_tie"]
    per_id = decided.select(*same, times.alias("_times")).groupBy(*same).agg(
        F.max("_times").alias("_most"), F.min("_times").alias("_least"), F.sum("_times").alias("_sum"), F.count("*").alias("_n")
    )
    per_id = per_id.withColumn("_more", F.col("_sum") - F.col("_least") * F.col("_n")).filter("_most > 0")
    known = per_id.select(*[F.col(c).alias(f"{c}_") for c in same], "_most", "_least", "_more", "_n")
    on = F.lit(True)
    for c in same:
        on = on & F.col(c).eqNullSafe(F.col(f"{c}_"))
    met = rows.join(known, on)
    even = met.filter("_most = _least").select("_row", F.col("_most").alias("_times"))
    # Only the rows at the cut of a source are numbered, one id and text each; stored random cells let many tasks number them.
    at_cut = met.filter("_most > _least").select("_row", "_least", "_more", F.xxhash64(*same).alias("_h"), F.lit(1).alias("_one"))
    at_cut = stored(at_cut.withColumn("_cell", F.floor(F.rand(11) * CELLS).cast("int")), "mix-cut")
    cut = sums_before(at_cut, ["_h"], "_cell", ["_cell"], "_one")
    cut = cut.select("_row", (F.col("_least") + (F.col(BEFORE) < F.col("_more")).cast("int")).alias("_times"))
    out = even.unionByName(cut).withColumn("_copy", F.explode(F.when(F.col("_times") > 0, F.sequence(F.lit(1), F.col("_times")))))
    return out.select("_row.*")
