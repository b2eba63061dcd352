"""Importance resampling towards a target text, with each distinct line counted once.

Features of a text are its runs of 1 to ``words`` consecutive words, hashed into buckets. A
bucket's gain is the logarithm of how much more frequent it is in the target than in the
corpus; a document's weight is the mean gain of its features. Documents are drawn by the
highest sums of weight and Gumbel noise from a hash of the id, which draws without
replacement in proportion to the exponential of the weights.

A newline parts words, so it cuts a text into lines whose features don't depend on what
stands around them. Distinct lines are found by a 128-bit hash; the features of each are
hashed once and count as often as the line occurs. Runs across newlines (``words`` above 1)
are added separately, from the words around each newline. A document's sums are those of
its lines, looked up by hash. Lines so frequent that there can be only ``FREQUENT`` of them
are looked up in a broadcast table of that many rows at most, all others by a join, so no
line gathers more than that share of the rows.

A null text has no words; a document without features weighs 0. A null id counts as an
empty one in the hash and comes last among ties. Repeated rows are drawn one by one, equal
ones in any order. Very long texts are read whole. An empty corpus gives no rows; an empty
target makes rare buckets gain. Extra columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brokerdw.llm.common import numbered, stored

BUCKETS, RUN = 10_000, 1
PERCENT, LEAST_WORDS = 10, 20
SEED = "2024"
FREQUENT = 1_000
# Copies of one row are listed in blocks of so many.
BLOCK = 4_096

# Letters in lower case, digits and all bytes beyond ASCII stay, the rest parts words.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256))
HAS_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


def line_buckets(words: list[bytes], run: int, buckets: int) -> list[int]:
    """The bucket of every run of 1 to ``run`` words."""
    found = [zlib.crc32(w) % buckets for w in words]
    for n in range(2, run + 1):
        found.extend(zlib.crc32(b" ".join(words[i : i + n])) % buckets for i in range(len(words) - n + 1))
    return found


def crossing_buckets(text: bytes, run: int, buckets: int) -> list[int]:
    """The bucket of every run of 2 to ``run`` words that a newline cuts."""
    words, line = [], []
    for i, part in enumerate(text.split(b"\n")):
        own = words_of(part)
        words.extend(own)
        line.extend([i] * len(own))
    found = []
    for start in range(len(words)):
        for end in range(start + 2, min(start + run, len(words)) + 1):
            if line[end - 1] != line[start]:
                found.append(zlib.crc32(b" ".join(words[start:end])) % buckets)
    return found


def _hash128(*columns: Column | str) -> tuple[Column, Column]:
    return F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)


def line_rows(docs: DataFrame, line: bool) -> DataFrame:
    """doc_id, d1, d2 (hash of the row), one (1 for a document's first line, else 0), h1, h2 (null without words), line."""
    d1, d2 = _hash128("doc_id", "text")
    cut = F.posexplode(F.split(F.coalesce(F.col("text"), F.lit("")), "\n")).alias("at", "line")
    rows = docs.select("doc_id", d1.alias("d1"), d2.alias("d2"), cut)
    full = F.col("line").rlike(HAS_WORD)
    h1, h2 = _hash128("line")
    rows = rows.filter(full | (F.col("at") == 0))
    kept = ["doc_id", "d1", "d2", F.when(F.col("at") == 0, 1).otherwise(0).cast("long").alias("one")]
    return rows.select(*kept, F.when(full, h1).alias("h1"), F.when(full, h2).alias("h2"), *(["line"] if line else []))


def distinct_lines(docs: DataFrame, run: int, buckets: int) -> DataFrame:
    """h1, h2, times, words, found (buckets of the line's features)."""
    lines = line_rows(docs, True).filter(F.col("h1").isNotNull())
    once = lines.groupBy("h1", "h2").agg(F.count("*").alias("times"), F.first("line").alias("line"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [words_of(v.as_py()) for v in batch.column(3).cast(pa.binary())]
            found = pa.array([line_buckets(w, run, buckets) for w in words], pa.list_(pa.int32()))
            sizes = pa.array(list(map(len, words)), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], sizes, found], ["h1", "h2", "times", "words", "found"])

    return once.mapInArrow(task, "h1 long, h2 long, times long, words long, found array<int>")


def bucket_counts(lines: DataFrame, docs: DataFrame, run: int, buckets: int) -> np.ndarray:
    """Occurrences per bucket: a distinct line's features times its occurrences, and runs across lines."""

    def sent(counts: np.ndarray) -> pa.RecordBatch:
        held = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], ["b", "n"])

    def of_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            times, found = batch.column(0).to_numpy(), batch.column(1)
            np.add.at(counts, found.flatten().to_numpy(), np.repeat(times, found.value_lengths().to_numpy()))
        yield sent(counts)

    def crossing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                np.add.at(counts, np.array(crossing_buckets(text.as_py() or b"", run, buckets), np.int64), 1)
        yield sent(counts)

    parts = lines.select("times", "found").mapInArrow(of_lines, "b long, n long")
    if run > 1:
        parts = parts.unionByName(docs.select("text").mapInArrow(crossing, "b long, n long"))
    whole = np.zeros(buckets, np.int64)
    for r in parts.groupBy("b").agg(F.sum("n").alias("n")).collect():  # one row a bucket at most
        whole[r["b"]] = r["n"]
    return whole


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the ratio of smoothed shares) per bucket."""
    all_s, all_t = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    ratio = lambda s, t: (float(t + 1) * all_s) / (float(s + 1) * all_t)
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def line_gains(lines: DataFrame, gains: np.ndarray) -> DataFrame:
    """h1, h2, times, words, n (features), gain (their sum) per distinct line."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(4)
            n = found.value_lengths().to_numpy().astype(np.int64)
            running = np.concatenate([[0], np.cumsum(gains[found.flatten().to_numpy()])])
            ends = np.cumsum(n)
            columns = [*batch.columns[:4], pa.array(n), pa.array(running[ends] - running[ends - n])]
            yield pa.RecordBatch.from_arrays(columns, ["h1", "h2", "times", "words", "n", "gain"])

    return lines.mapInArrow(task, "h1 long, h2 long, times long, words long, n long, gain long")


def crossing_gains(docs: DataFrame, run: int, gains: np.ndarray) -> DataFrame:
    """d1, d2, n, gain of the runs across lines, per row."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [crossing_buckets(v.as_py() or b"", run, len(gains)) for v in batch.column(3).cast(pa.binary())]
            n = pa.array(list(map(len, found)), pa.int64())
            gain = pa.array([int(gains[np.array(f, np.int64)].sum()) for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], n, gain], ["doc_id", "d1", "d2", "n", "gain"])

    d1, d2 = _hash128("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", d1.alias("d1"), d2.alias("d2"), "text")
    return rows.mapInArrow(task, f"doc_id {kind}, d1 long, d2 long, n long, gain long")


def document_sums(docs: DataFrame, lines: DataFrame, run: int, gains: np.ndarray) -> DataFrame:
    """doc_id, d1, d2, copies (equal rows), words, n, gain (each of one copy)."""
    places = stored(line_rows(docs, False), "resampling-places")
    known = line_gains(lines, gains)
    limit = (known.agg(F.coalesce(F.sum("times"), F.lit(0)).alias("n")).first()["n"]) // FREQUENT
    # The occurrences of frequent lines add up to all at most, so there are less than FREQUENT of them.
    frequent = F.broadcast(known.filter(F.col("times") > limit).drop("times"))
    rare = known.filter(F.col("times") <= limit).drop("times")
    key = ["h1", "h2"]
    kept = ["doc_id", "d1", "d2", "one", "words", "n", "gain"]
    nothing = [F.lit(0).cast("long").alias(c) for c in ("words", "n", "gain")]
    looked_up = [
        places.filter("h1 is null").select("doc_id", "d1", "d2", "one", *nothing),
        places.join(frequent, key).select(*kept),
        places.filter("h1 is not null").join(frequent, key, "left_anti").join(rare, key).select(*kept),
    ]
    if run > 1:
        one = F.lit(0).cast("long").alias("one")
        looked_up.append(crossing_gains(docs, run, gains).select("doc_id", "d1", "d2", one, nothing[0], "n", "gain"))
    rows = looked_up[0]
    for more in looked_up[1:]:
        rows = rows.unionByName(more)
    sums = rows.groupBy("doc_id", "d1", "d2").agg(*[F.sum(c).alias(c) for c in ("one", "words", "n", "gain")])
    # Equal rows share a key and have equal parts in its sums.
    return sums.select("doc_id", "d1", "d2", F.col("one").alias("copies"), *[F.expr(f"{c} div one").alias(c) for c in ("words", "n", "gain")])


def resample(
    docs: DataFrame,
    target: DataFrame,
    run: int = RUN,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: str = SEED,
) -> DataFrame:
    """Per row: doc_id, n_features, weight, score, rank (null where not drawn); ``target`` has a column text."""
    lines = stored(distinct_lines(docs, run, buckets), "resampling-lines")
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), "text")
    wanted_lines = stored(distinct_lines(wanted, run, buckets), "resampling-target")
    corpus = bucket_counts(lines, docs, run, buckets)
    gains = bucket_gains(corpus, bucket_counts(wanted_lines, wanted, run, buckets))
    sums = document_sums(docs, lines, run, gains)

    weight = F.when(F.col("n") > 0, F.expr("(gain - pmod(gain, n)) div n")).otherwise(0)
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8)
    h = F.conv(head, 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    rows = sums.select(
        "doc_id",
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {BLOCK}"))).alias("_block"),
        "copies",
        F.col("n").alias("n_features"),
        weight.cast("long").alias("weight"),
        (weight + noise).cast("long").alias("score"),
        (F.col("words") >= least_words).alias("_fit"),
    )
    first = F.col("_block") * BLOCK
    rows = rows.withColumn("_copy", F.explode(F.sequence(first + 1, F.least(first + BLOCK, F.col("copies"))))).drop("_block", "copies")
    order = [F.desc("_fit"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_copy")]
    ranked = numbered(rows, order, "_number", "resampling-rows")
    fit = ranked.agg(F.coalesce(F.sum(F.col("_fit").cast("long")), F.lit(0)).alias("n")).first()["n"]
    drawn = F.col("_fit") & (F.col("_number") <= fit * percent // 100)
    return ranked.select("doc_id", "n_features", "weight", "score", F.when(drawn, F.col("_number")).cast("long").alias("rank"))
