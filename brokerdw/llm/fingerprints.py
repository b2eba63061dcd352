"""Document fingerprints: bottom-k sketches of word shingles, in DataFrame functions only.

A fingerprint is the k smallest of the distinct hashes of a text's shingles of five words
(lower case, parted by white space); a text of fewer words has one shingle. Sketches merge:
the k smallest of two sketches' hashes are the sketch of the union. From two sketches follow
estimates of resemblance, containment and the number of distinct shingles; they are exact
while a set has fewer than k.

Nulls count as empty texts; an empty text has an empty sketch, which resembles only empty
ones. Long texts are read whole; repeated rows are treated one by one; an empty table gives
no rows; extra columns are not read. The edits need the documents' order, so there doc_id must
be a number, of any size; null ids come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORDS, K = 5, 128
# Documents in order of doc_id are dealt to at most GROUPS * GROUP_CELLS cells of about CELL_ROWS rows.
GROUPS, GROUP_CELLS, CELL_ROWS = 64, 1_024, 1_000


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a text, in order."""
    blank = F.translate(F.lower(text), "\t\n\r\x0b\f", "     ")
    return F.transform(F.array_remove(F.split(blank, " "), ""), lambda w: F.xxhash64(w))


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(hashes), 1, k)


def with_sketch(df: DataFrame, text: str, out: str, words: int = WORDS, k: int = K) -> DataFrame:
    """Add the sketch of a text column: an ascending array of at most ``k`` longs."""
    h = F.col("_h")
    size = F.size(h)
    shingle = lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(words)])
    many = F.transform(F.sequence(F.lit(0), size - words), shingle)
    found = F.when(size == 0, F.array().cast("array<long>")).when(size < words, F.array(F.xxhash64(h))).otherwise(many)
    hashed = df.withColumn("_h", word_hashes(F.coalesce(F.col(text), F.lit(""))))
    return hashed.withColumn(out, bottom(F.array_distinct(found), k)).drop("_h")


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union."""
    return bottom(F.array_union(a, b), k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity, 0 to 1."""
    union = merged(a, b, k)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    span = (F.element_at(a, -1).cast("double") + float(1 << 63)) / float(1 << 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / span)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has, 0 to 1."""
    common = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, k)))


def shown(sketch: Column) -> Column:
    """Sixteen hexadecimal digits a hash."""
    return F.array_join(F.transform(sketch, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def merge_sketches(df: DataFrame, group: list[str], sketch: str, k: int = K) -> DataFrame:
    """One sketch per group: the k smallest hashes of its sketches, limited before the shuffle."""
    hashes = df.select(*group, F.explode(sketch).alias("_x"))
    rank = F.dense_rank().over(Window.partitionBy(*group).orderBy("_x"))
    least = hashes.withColumn("_r", rank).filter(F.col("_r") <= k)
    return least.groupBy(*group).agg(F.sort_array(F.collect_set("_x")).alias(sketch))


def with_cells(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with ``_cell``, which grows with doc_id; and per cell its first doc_id and the cell before.

    Cells are equal parts of the ranges between quantiles of doc_id, 65,536 at most, so the
    second table is small whatever the input. Null ids are in cell -1.
    """
    number = F.col("doc_id").cast("double")
    shares = [i / GROUPS for i in range(GROUPS + 1)]
    stats = docs.select(number.alias("x")).agg(
        F.percentile_approx("x", shares, 10_000).alias("q"), F.count("x").alias("n"), F.max("x").alias("hi"), F.min("x").alias("lo")
    ).first()
    q = sorted({stats["lo"], *stats["q"], stats["hi"]}) if stats["n"] else [0.0]
    per_group = max(1, min(GROUP_CELLS, round(stats["n"] / GROUPS / CELL_ROWS)))
    edges = F.array(*[F.lit(float(x)) for x in q])
    group = F.size(F.filter(edges, lambda e: e <= number))
    low = F.element_at(edges, F.col("_g"))
    high = F.coalesce(F.get(edges, F.col("_g")), low + 1)
    # Beyond 2**53 neighbouring ids are one double: such ids share a part, and a range may have no width.
    width = F.greatest(high - low, F.lit(1.0))
    part = F.least(F.lit(per_group - 1), F.floor((number - low) / width * per_group)).cast("int")
    grouped = docs.withColumn("_g", F.when(number.isNull(), F.lit(0)).otherwise(group))
    cell = F.when(F.col("_g") == 0, F.lit(-1)).otherwise(F.col("_g") * per_group + part)
    celled = grouped.withColumn("_cell", cell.cast("int")).drop("_g")
    first = celled.groupBy("_cell").agg(F.min("doc_id").alias("_first"))
    order = Window.orderBy("_cell")
    last = F.max("_cell").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return celled, first.withColumn("_before", F.coalesce(F.lag("_cell").over(order), last))


def with_next(docs: DataFrame) -> tuple[DataFrame, object]:
    """Rows in order of doc_id within cells, each cell followed by the next one's first row, and the window over them.

    The first row of a cell is sent to the cell before it as well (``_guest``), so that every
    row finds its successor in its own cell; after the last document comes the first.
    """
    own = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    celled, firsts = with_cells(own)
    is_first = celled["doc_id"].eqNullSafe(F.col("_first"))
    known = celled.join(F.broadcast(firsts), "_cell")  # a row per cell: at most GROUPS * GROUP_CELLS + 1
    here = F.struct(F.col("_cell").alias("c"), F.lit(0).alias("g"))
    there = F.struct(F.col("_before").alias("c"), F.lit(1).alias("g"))
    sent = known.select("doc_id", "text", F.explode(F.when(is_first, F.array(here, there)).otherwise(F.array(here))).alias("x"))
    rows = sent.select("doc_id", "text", F.col("x.c").alias("_cell"), F.col("x.g").alias("_guest"))
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    return rows, Window.partitionBy("_cell").orderBy("_guest", F.col("doc_id").asc_nulls_first(), "_tie")


def fingerprint_edits(docs: DataFrame, words: int = WORDS, k: int = K) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, the sketches of the text and of its edited text, and likenesses.

    The edited text has its last floor(n_chars / 2) code points replaced by as many of the
    next document's first ones (or all).
    """
    rows, order = with_next(docs)
    rows = rows.withColumn("_next", F.lead("text").over(order))
    rows = with_sketch(rows, "text", "sketch", words, k)
    rows = rows.withColumn("_next_sketch", F.lead("sketch").over(order)).filter("_guest = 0")
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    kept = (F.col("n_chars") - half).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), kept), F.substring("_next", F.lit(1), half))
    rows = rows.withColumn("_edited", edited)
    rows = with_sketch(rows, "_edited", "edited_sketch", words, k)
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("_edited", 256).alias("edited_sha256"),
        "sketch",
        "edited_sketch",
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("_next_sketch"), k).alias("near_next"),
    )
