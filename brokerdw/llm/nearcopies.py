"""Near copies by fast similarity sketches, banding and exact verification.

A sketch has ``COORDINATES`` bins. In round i every shingle falls into one bin, and a bin
keeps its smallest value of the earliest round that reached it; after as many rounds as
bins, round i goes to bin i alone, so every bin fills and the share of equal bins
concentrates around the Jaccard similarity. A sketch is cut into ``BANDS`` bands; texts
that share a band are candidates, and every link is confirmed on the full shingle sets. At
a similarity of 0.8 a pair shares no band with a probability of 1.3e-7.

Texts with the same shingle set are one node. In a bucket of nodes all are first compared
with one of them. Where a bucket then still holds several components, its nodes go through
an exact prefix filter, and those that pass and differ in component are compared block by
block, without a row for each pair. A large group of copies so costs about one comparison a node and band, and no link
that could join two components goes unchecked.

Nulls and texts without words have no shingles and are linked with nothing. Texts of fewer
words than a shingle have one shingle. Rows that repeat an id are one document. Rows
without an id form components like others; the component's id is its smallest id that
is not null. Long texts are read whole; an empty table gives no rows; extra columns are
not read (``one_of_each`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brokerdw.llm.common import stored

WORDS, PERCENT = 5, 80
BANDS, ROWS = 40, 5
COORDINATES = BANDS * ROWS
# Bits of the filter that spares reading most texts a second time; its size is fixed.
FILTER_BITS = 1 << 22
# Shingles of the sets in a block.
BLOCK_SHINGLES = 1 << 16
REMEMBERED = 60_000
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text (A-Z lower-cased)."""
    found = (text or "").encode("utf-8").lower().split()
    h = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    if not len(h):
        return h
    size = min(words, len(h))
    g = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        g = mix(g * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - size + 1 + i])
    return np.unique(g)


def sketch(g: np.ndarray, bins: int = COORDINATES) -> np.ndarray:
    """Rounds of hashed bin placement until every bin is filled."""
    out = np.full(bins, ALL)
    at_once = max(1, bins // (2 * len(g)))  # few shingles fill few bins a round
    for start in range(0, bins, at_once):
        rounds = np.arange(start, min(bins, start + at_once), dtype=np.uint64)[:, None]
        x = mix(g[None, :] ^ mix(rounds + np.uint64(1)))
        np.minimum.at(out, (x % np.uint64(bins)).astype(np.int64), (rounds << np.uint64(54)) | (x >> np.uint64(10)))
        if (out != ALL).all():
            return out
    for b in np.flatnonzero(out == ALL):
        r = np.uint64(bins + b)
        out[b] = (r << np.uint64(54)) | (mix(g ^ mix(np.array([r + np.uint64(1)]))).min() >> np.uint64(10))
    return out


def band_keys(s: np.ndarray) -> np.ndarray:
    g = np.arange(BANDS, dtype=np.uint64)
    for column in s.reshape(BANDS, ROWS).T:
        g = mix(g * np.uint64(0x9E3779B97F4A7C15) + column)
    return g.view(np.int64)


def node_of(g: np.ndarray) -> int:
    return int(np.array(xxhash.xxh3_64_intdigest(g.tobytes()), np.uint64).view(np.int64))


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """Per row: doc_id, tie (hash of the text), n (set size), node (hash of the set), bands."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, nodes, bands = [], [], []
            for value in batch.column(2):
                g = shingles(value.as_py(), words, hashes)
                sizes.append(len(g))
                nodes.append(node_of(g) if len(g) else None)
                bands.append(band_keys(sketch(g)) if len(g) else np.zeros(0, np.int64))
            ends = pa.array(np.cumsum([0, *map(len, bands)]), pa.int32())
            keys = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int64), *bands])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), keys],
                ["doc_id", "tie", "n", "node", "bands"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("tie"), "text")
    return rows.mapInArrow(task, f"doc_id {kind}, tie long, n long, node long, bands array<long>")


def shingle_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """node, set (sorted hashes) for ``wanted``: node, doc_id, tie of one document per node."""
    slot = F.pmod(F.xxhash64("doc_id", "tie"), F.lit(FILTER_BITS))
    bits = wanted.select(slot.alias("slot")).groupBy(F.expr("slot div 64").alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits")
    )
    filled = np.zeros(FILTER_BITS // 64, np.int64)
    for row in bits.collect():  # at most FILTER_BITS / 64 rows
        filled[row["at"]] = row["bits"]

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).to_numpy()
            yield batch.filter(pa.array((filled[at // 64] >> (at % 64)) & 1 == 1))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                sets = [shingles(t, words, hashes).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["node", "set"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.xxhash64("text").alias("tie"), "text").select(slot.alias("slot"), "doc_id", "tie", "text")
    likely = texts.mapInArrow(keep, f"slot long, doc_id {kind}, tie long, text string").drop("slot")
    ids = wanted.select("node", F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie"))
    met = likely.join(ids, same).dropDuplicates(["node"]).select("node", "text")
    return met.mapInArrow(task, "node long, set binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b whose full sets are similar enough."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                good.append(100 * common >= percent * (len(both) - common))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    second = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    first = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    met = pairs.join(second, "b").join(first, "a").select("a", "b", "set_a", "set_b")
    return met.mapInArrow(task, "a long, b long")


def posts(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """s, node, n, i: the shingles at the front of each set's order, by which similar sets must meet.

    With shingles in order of rarity, two similar sets share one among their first
    n - ceil(n * percent / 100) + 1. A variant whose own edits fill these places meets nobody.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, data in zip(batch.column(0), batch.column(1), strict=True):
                s = np.frombuffer(data.as_buffer(), np.int64)
                same = np.full(len(s), node.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(same), pa.array(s)], ["node", "s"])

    held = sets.join(nodes.select("node"), "node").select("node", "set").mapInArrow(task, "node long, s long")
    shared = held.groupBy("s").agg(F.count("*").alias("c")).filter("c > 1")
    own = Window.partitionBy("node")
    place = F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("c", "s")) - 1
    room = F.col("n") - F.ceil(F.col("n") * percent / 100)
    front = held.join(shared, "s").join(nodes, "node").withColumn("i", place).filter(F.col("i") <= room)
    return front.select("s", "node", "n", "i")


def common_counts(a: list[np.ndarray], b: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """Per set of ``a``: how many elements it has in common with each set of ``b``."""
    held = np.concatenate(b)
    owner = np.repeat(np.arange(len(b)), [len(x) for x in b])
    order = np.argsort(held, kind="stable")
    held, owner = held[order], owner[order]
    for i, x in enumerate(a):
        low, high = np.searchsorted(held, x, "left"), np.searchsorted(held, x, "right")
        size = high - low
        at = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
        yield i, np.bincount(owner[at], minlength=len(b))


def block_links(front: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links a, b between nodes of different components that share a shingle of ``posts``.

    The holders of a shingle form the family of its most frequent component. The nodes of
    a family that are in other components are compared with all of it, block by block:
    a row holds two blocks of sets, whatever the number of pairs between them, and gives
    one link for each node and component it meets. Blocks have a bounded number of shingles.
    """
    rows = front.join(found, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    groups = rows.groupBy("s", "comp").agg(F.count("*").alias("c"))
    most = groups.groupBy("s").agg(F.max_by("comp", F.struct("c", "comp")).alias("family"), F.count("*").alias("k"))
    members = rows.join(most.filter("k > 1").drop("k"), "s").select("family", "node", "comp", "n").distinct()
    members = stored(members.withColumn("other", F.col("comp") != F.col("family")), "copies-families")
    total = members.groupBy("family", "other").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("blocks"))
    placed = members.join(total, ["family", "other"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    full = placed.join(sets, "node").groupBy("family", "other", "block").agg(
        F.collect_list(F.struct("node", "comp", "set")).alias("nodes")
    )
    full = stored(full, "copies-blocks")
    keys = full.select("family", "other", "block")
    one = keys.filter("other").select("family", F.col("block").alias("x"))
    two = keys.select("family", F.col("other").alias("o"), F.col("block").alias("y"))
    pairs = one.join(two, "family").filter("not o or x <= y")
    left = full.filter("other").select("family", F.col("block").alias("x"), F.col("nodes").alias("first"))
    right = full.select("family", F.col("other").alias("o"), F.col("block").alias("y"), F.col("nodes").alias("second"))
    met = pairs.join(left, ["family", "x"]).join(right, ["family", "o", "y"]).select("first", "second")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                first, second = (batch.column(k)[i].as_py() for k in (0, 1))
                x, y = ([np.frombuffer(r["set"], np.uint64) for r in rows_] for rows_ in (first, second))
                sizes = np.array([len(s) for s in y])
                comps = np.array([r["comp"] for r in second])
                links = []
                for j, common in common_counts(x, y):
                    good = 100 * common >= percent * (len(x[j]) + sizes - common)
                    good &= comps != first[j]["comp"]
                    _, at = np.unique(comps[good], return_index=True)
                    links += [(first[j]["node"], second[k]["node"]) for k in np.flatnonzero(good)[at]]
                columns = [pa.array([link[k] for link in links], pa.int64()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    return met.mapInArrow(task, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node, comp (smallest node reachable) of nodes a, b with edges, by alternating large and small stars."""
    edges = stored(edges.select("a", "b").distinct(), "copies-edges")
    before = None
    while True:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.union(both.join(low, "u").filter("u != m").select("u", F.col("m").alias("v"))).distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").filter("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        small = small.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()
        edges = stored(small, "copies-edges")
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
        before = state


def cluster(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, tie, n_shingles, component_id, kept."""
    rows = stored(sketches(docs, words), "copies-sketches")
    nodes = rows.filter("n > 0").groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tie")).alias("low"), F.first("n").alias("n")
    )
    buckets = rows.select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("lead"), F.max("node").alias("_hi")).filter("lead != _hi")
    members = stored(buckets.join(shared.drop("_hi"), "bucket").distinct(), "copies-members")
    wanted = members.select("node").distinct().join(nodes, "node").select("node", "low.doc_id", "low.tie", "n")
    wanted = stored(wanted, "copies-wanted")
    sets = stored(shingle_sets(docs, wanted, words), "copies-sets")
    size = wanted.select("node", "n")
    similar = F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent  # sizes that allow a link

    leads = members.filter("node != lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    sized = leads.join(size.toDF("a", "n"), "a").join(size.toDF("b", "n2"), "b").filter(similar)
    links = stored(verified(sized.select("a", "b"), sets, percent), "copies-links")
    found = components(links)

    labelled = members.join(found, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    several = labelled.groupBy("bucket").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi")).filter("_lo != _hi")
    open_ = labelled.join(several.select("bucket"), "bucket").select("node").distinct().join(size, "node")
    front = stored(posts(stored(open_, "copies-open"), sets, percent), "copies-posts")
    found = components(links.union(block_links(front, found, sets, percent)))

    placed = nodes.join(found, "node", "left").select("node", "low", F.coalesce("comp", "node").alias("comp"))
    lowest = placed.groupBy("comp").agg(F.min("low").alias("keep"))
    decided = placed.join(lowest, "comp").select("node", "keep")
    out = rows.drop("bands").join(decided, "node", "left")
    own = F.struct(F.col("doc_id").isNull(), "doc_id", "tie")
    kept = F.when(F.col("keep").isNull(), F.lit(True)).otherwise(F.col("keep.doc_id").eqNullSafe(F.col("doc_id")))
    kept = kept & (F.col("keep").isNull() | F.col("doc_id").isNotNull() | (F.col("keep") == own))
    component = F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id"))
    return out.select("doc_id", "tie", F.col("n").alias("n_shingles"), component.alias("component_id"), kept.alias("kept"))


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, one document of each component, with all columns."""
    chosen = cluster(docs, words, percent).filter("kept").select(F.col("doc_id").alias("_id"), F.col("tie").alias("_t"))
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_i"), F.xxhash64("text").alias("_tie"))
    same = F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_tie") == F.col("_t"))
    return rows.join(chosen, same, "left_semi").dropDuplicates(["_i", "_tie"]).select("_row.*")
