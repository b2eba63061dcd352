"""Source divergence audit: how far the word use of the sources of a language lies apart.

Every language keeps the terms (runs of letters) that stand in at least ``LEAST`` of its
documents. A source gives a kept term that it holds ``count`` times the share
p = 1 + floor(SCALE * (count + ADD) / (N + ADD * V)), N being its occurrences of kept terms
and V their number. The distance of two sources is the sum of |p - p'| over all kept terms.

Summing over all pairs for every term would cost sources squared times terms. A term that a
source lacks has the same share z there, so the distance is

    V * |z - z'|  +  what the terms of either source alone change  +  a correction for the
    terms that both hold.

The second part follows from each source's histogram of shares by one ordered sweep. The
third comes from a frequent-pattern tree: the row of a term is its nonzero shares in a fixed
order of the sources, equal rows are one row with a multiplicity, and rows are inserted into
a tree whose shared beginnings are shared paths. A node that stands for m terms adds, once,
m times its correction with each of its ancestors. Rows sorted by path walk that tree depth
first, so a task holds one path and the sums of pairs, whatever the number of terms. A path
that is cut between two tasks only is walked twice.

Null texts, languages and sources count as ''. Empty texts have no terms but their group
still counts; a language without kept terms has distances 0 and no term rows. Very long
texts are read whole; repeated rows count as often as they stand; an empty table gives no
rows; extra columns are not read. A language's sources are compared pairwise because every
pair is a row of the result; one term's row holds at most one entry per source. Counts are
exact up to 2**63, shares are computed as decimals.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brokerdw.llm.common import stored

LEAST, SCALE, ADD = 30, 1_000_000_000, 5
TOP_TERMS = 50
# Distinct (group, term) entries that a task counts before it passes them on.
ENTRIES = 150_000
# Sums of pairs that a task holds before it passes them on.
PAIR_SUMS = 2_000_000
# Steps of a path that decide which task walks it.
STEPS = 2

# Letters in lower case and all bytes beyond ASCII stay, the rest parts terms.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8; only A to Z are put into lower case."""
    return text.translate(LETTERS).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, n (occurrences), d (documents), added up within the task."""
    seen: dict[tuple[bytes, bytes], Counter] = defaultdict(Counter)
    docs: dict[tuple[bytes, bytes], Counter] = defaultdict(Counter)
    names = ["lang", "source", "term", "n", "d"]

    def passed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), found in seen.items():
            held = docs[lang, source]
            text = lambda values: pa.array(values, pa.binary()).cast(pa.string())
            columns = [text([lang] * len(found)), text([source] * len(found)), text(list(found))]
            counts = [pa.array(list(found.values()), pa.int64()), pa.array([held[t] for t in found], pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, *counts], names)
        seen.clear()
        docs.clear()

    entries = 0
    for batch in batches:
        for lang, source, text in zip(*(c.cast(pa.binary()) for c in batch.columns), strict=True):
            found = terms(text.as_py())
            if not found:
                continue
            group = lang.as_py(), source.as_py()
            before = len(seen[group])
            seen[group].update(found)
            docs[group].update(set(found))
            entries += len(seen[group]) - before
            if entries >= ENTRIES:
                yield from passed_on()
                entries = 0
    yield from passed_on()


def kept_terms(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, term, items (source, n): the terms of at least ``least`` documents of the language."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    texts = docs.select(empty("lang"), empty("source"), empty("text"))
    counted = texts.mapInArrow(_count, "lang string, source string, term string, n long, d long")
    # One exchange serves both groupings.
    dealt = counted.repartition("lang", "term")
    per_source = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    rows = per_source.groupBy("lang", "term").agg(F.sum("d").alias("d"), F.collect_list(F.struct("source", "n")).alias("items"))
    return rows.filter(F.col("d") >= least).select("lang", "term", "items")


def share(count: Column, whole: Column, v: Column, scale: int = SCALE, add: int = ADD) -> Column:
    """1 + floor(scale * (count + add) / (whole + add * v)), exactly; v is above 0."""
    top = (count + add).cast("decimal(20,0)") * F.lit(scale).cast("decimal(10,0)")
    low = (whole + v * add).cast("decimal(20,0)")
    return F.call_function("div", top, low) + 1


def source_groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, whole (N), v, zero (the share of a term that the source lacks), place (order of sources).

    Sources with few terms come first: their counts are small, so that the tree's paths
    begin alike.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    groups = docs.select(empty("lang"), empty("source")).distinct()
    items = kept.select("lang", F.inline("items"))
    wholes = items.groupBy("lang", "source").agg(F.sum("n").alias("whole"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"))
    full = groups.join(wholes, ["lang", "source"], "left").join(sizes, "lang", "left").fillna(0, ["whole", "v"])
    zero = F.when(F.col("v") > 0, share(F.lit(0), F.col("whole"), F.greatest("v", F.lit(1)))).otherwise(0)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("whole", "source"))
    return full.select("lang", "source", "whole", "v", zero.cast("long").alias("zero"), place.alias("place"))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, a, b, f: corrections of pairs of places, from rows ``lang, path, m`` sorted by path."""
    lang, place, p, z = None, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    held: list[int] = []  # terms below each node of the current path
    sums: dict[int, np.ndarray] = {}  # for a node's place, the sums with all smaller places

    def leave(depth: int) -> None:
        """Nodes below ``depth`` are whole: add each one's corrections with its ancestors."""
        for d in range(len(held) - 1, depth - 1, -1):
            m = held.pop()
            if not d:
                continue
            up_p, up_z = p[:d], z[:d]
            both = np.abs(up_p - p[d]) - np.abs(up_p - z[d]) - np.abs(up_z - p[d]) + np.abs(up_z - z[d])
            own = sums.setdefault(int(place[d]), np.zeros(int(place[d]), np.int64))
            own[place[:d]] += m * both
            held[-1] += m

    def passed_on() -> Iterator[pa.RecordBatch]:
        for b, own in sums.items():
            a = np.flatnonzero(own)
            columns = [pa.array([lang] * len(a), pa.string()), pa.array(a), pa.array(np.full(len(a), b)), pa.array(own[a])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "a", "b", "f"])
        sums.clear()

    for batch in batches:
        paths, times = batch.column(1), batch.column(2).to_numpy()
        ends = paths.offsets.to_numpy()
        cells = [paths.values.field(i).to_numpy() for i in range(3)]
        for i, name in enumerate(batch.column(0).to_pylist()):
            new = [c[ends[i] : ends[i + 1]] for c in cells]
            if name != lang:
                leave(0)
                yield from passed_on()
                lang, shared = name, 0
            else:
                n = min(len(place), len(new[0]))
                other = np.flatnonzero((place[:n] != new[0][:n]) | (p[:n] != new[1][:n]))
                shared = int(other[0]) if len(other) else n
                leave(shared)
                if sum(map(len, sums.values())) > PAIR_SUMS:
                    yield from passed_on()
            place, p, z = new
            held.extend([0] * (len(place) - shared))
            held[-1] += int(times[i])
    leave(0)
    yield from passed_on()


def tree_corrections(shares: DataFrame) -> DataFrame:
    """lang, a, b, f: for places a < b, the corrections of the terms that both hold (``lang, term, place, p, zero``)."""
    row = F.sort_array(F.collect_list(F.struct("place", "p", "zero"))).alias("path")
    paths = shares.groupBy("lang", "term").agg(row).groupBy("lang", "path").agg(F.count("*").alias("m"))
    # The ranges are cut by the first steps alone: Spark samples the columns that cut them.
    ordered = paths.repartitionByRange("lang", F.slice("path", 1, STEPS)).sortWithinPartitions("lang", "path")
    walked = ordered.mapInArrow(_walk, "lang string, a long, b long, f long")
    return walked.groupBy("lang", "a", "b").agg(F.sum("f").alias("f"))


def lone_changes(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, other, base, f: sums of |p - x| - |zero - x| over the terms of ``source``, x the zero of ``other``.

    A sweep over each source's distinct shares and the other sources' zeros, in order; a
    source with N occurrences has at most sqrt(2 N) distinct shares.
    """
    held = shares.groupBy("lang", "source", F.col("p").alias("x")).agg(F.count("*").alias("m"))
    mine = groups.select("lang", "source", "v", "place", "zero")
    others = groups.select("lang", F.col("source").alias("other"), F.col("place").alias("other_place"), F.col("zero").alias("x"))
    asked = mine.join(others, "lang").filter("place <> other_place").withColumn("m", F.lit(0).cast("long"))
    rows = asked.unionByName(held, allowMissingColumns=True)
    key = Window.partitionBy("lang", "source")
    below = key.orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    mass = F.col("m") * F.col("x")
    swept = rows.select(
        "*", F.sum("m").over(below).alias("m1"), F.sum(mass).over(below).alias("s1"), F.sum("m").over(key).alias("m2"), F.sum(mass).over(key).alias("s2")
    ).filter("other is not null")
    x, gap = F.col("x"), F.abs(F.col("zero") - F.col("x"))
    apart = x * F.col("m1") - F.col("s1") + (F.col("s2") - F.col("s1")) - x * (F.col("m2") - F.col("m1"))
    return swept.select(
        "lang", "source", "other", F.col("place").alias("a"), F.col("other_place").alias("b"), (F.col("v") * gap).alias("base"), (apart - F.col("m2") * gap).alias("f")
    )


def distances(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (another source of the language), value."""
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    first = F.col("a") < F.col("b")
    lone = lone_changes(shares, groups)
    known = lone.select(
        "lang",
        low,
        high,
        (F.col("f") + F.when(first, F.col("base")).otherwise(0)).alias("f"),
        F.when(first, F.struct(F.col("source").alias("s"), F.col("other").alias("t"))).alias("names"),
    )
    both = tree_corrections(shares).withColumn("names", F.lit(None).cast("struct<s:string,t:string>"))
    pairs = known.unionByName(both).groupBy("lang", "a", "b").agg(F.sum("f").alias("value"), F.max("names").alias("names"))
    turned = F.array(F.col("names"), F.struct(F.col("names.t").alias("s"), F.col("names.s").alias("t")))
    one = pairs.select("lang", "value", F.explode(turned).alias("x"))
    return one.select("lang", F.col("x.s").alias("source"), F.col("x.t").alias("item"), "value")


def audit(docs: DataFrame, least: int = LEAST, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank.

    ``pair``: every other source of the language and its distance, farthest first. ``term``:
    the ``top_terms`` kept terms whose share in the source exceeds the language's the most.
    """
    kept = stored(kept_terms(docs, least), "divergence-terms")
    groups = stored(source_groups(docs, kept), "divergence-groups")
    wholes = groups.groupBy("lang").agg(F.sum("whole").alias("lang_whole"))
    count = F.aggregate("items", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    listed = kept.join(wholes, "lang").select("lang", "term", "lang_whole", count.alias("lang_n"), F.inline("items"))
    shares = listed.join(groups, ["lang", "source"]).select(
        "lang",
        "source",
        "term",
        "place",
        "zero",
        share(F.col("n"), F.col("whole"), F.col("v")).alias("p"),
        share(F.col("lang_n"), F.col("lang_whole"), F.col("v")).alias("q"),
    )
    shares = stored(shares, "divergence-shares")
    above = shares.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    best = above.select("*", rank).filter(F.col("rank") <= top_terms).withColumn("part", F.lit("term"))
    far = distances(shares, groups).select("*", rank).withColumn("part", F.lit("pair"))
    return far.unionByName(best).select("lang", "source", "part", "item", "value", "rank")
