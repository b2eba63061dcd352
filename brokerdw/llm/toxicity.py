"""Toxicity by non-negative positive-unlabelled learning.

Positives are documents confirmed as toxic; everything else counts as unlabelled text with
a known share of positives (the class prior). The risk of calling unlabelled text negative
is corrected by that share and kept from falling below zero. Linear classifiers in numpy
are trained on overlapping parts of a bounded sample; a document's score is the logistic
function of their mean. Features are the words of a text and their beginnings, present or
not, as far as they are clearly more frequent in positives.

Nulls and empty texts have no features and get the score of the bias; long texts are read
whole; labels that are null, or of unknown documents, are not used; a document with several
labels is toxic if one says so. Without any confirmed toxic document every score is 0. An
empty table gives no rows. Repeated rows get the same score; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brokerdw.llm.common import stored

# Expected number of sampled documents that are confirmed toxic, and of others.
POSITIVES, UNLABELLED = 4_000, 12_000
# A feature stands in at least so many positives, with a difference of so many standard errors.
LEAST, ERRORS = 3, 4.5
BEGINNINGS = (3, 4, 5)
# Classifiers; steps, step size and weight decay of each.
PARTS, STEPS, RATE, DECAY = 4, 240, 0.05, 1e-4
# The loss of calling a text negative grows no further beyond this margin, so that sure positives don't outweigh the rest.
CLIP = 3.0
THRESHOLD = 0.3
HELD_OUT = 2  # the remainder modulo 4 that labels are not learned from
REMEMBERED = 60_000
# Features that a task counts before it passes the counts on.
COUNTED = 100_000
WORDS = re.compile(r"[^\W\d_]+")


def fold(doc_id: Column, parts: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def uniform(column: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(column, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)


def features(word: str) -> list[str]:
    return [f"={word}", *(f"^{word[:n]}" for n in BEGINNINGS if len(word) > n)]


def document_features(text: str | None) -> set[str]:
    return {f for w in set(WORDS.findall((text or "").lower())) for f in features(w)}


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float
    known: bool = True


def train(ids: list[np.ndarray], positive: np.ndarray, size: int, prior: float) -> np.ndarray:
    """Weights, then the bias, of one classifier (logistic loss, Adam, all rows in each step)."""

    def rows(which: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        chosen = [ids[i] for i in np.flatnonzero(which)]
        at = np.repeat(np.arange(len(chosen)), [len(x) for x in chosen])
        return np.concatenate([*chosen, np.zeros(0, int)]).astype(int), at, max(1, len(chosen))

    w = np.zeros(size + 1)
    w[-1] = math.log(prior / (1 - prior))
    mean, square = np.zeros(size + 1), np.zeros(size + 1)
    sides = {True: rows(positive), False: rows(~positive)}
    score = lambda x: np.bincount(x[1], w[x[0]], x[2]) + w[-1]
    chance = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for step in range(1, STEPS + 1):
        zp, zu = score(sides[True]), score(sides[False])
        gp, gu = -prior * chance(-zp) / len(zp), np.zeros(len(zu))
        bounded = lambda z: np.logaddexp(0, np.minimum(z, CLIP)).mean()
        if bounded(zu) > prior * bounded(zp):  # the corrected risk counts only while above zero
            gp -= prior * chance(zp) * (zp < CLIP) / len(zp)
            gu = chance(zu) * (zu < CLIP) / len(zu)
        g = DECAY * w
        g[-1] = 0
        for x, gx in ((sides[True], gp), (sides[False], gu)):
            g[:-1] += np.bincount(x[0], gx[x[1]], size)
            g[-1] += gx.sum()
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))  # falls in the second half
        w -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return w


def sample(docs: DataFrame, confirmed: DataFrame, positives: int, others: int, total: int) -> DataFrame:
    """Stored ``_id, text, positive``; ``confirmed``: doc_id of toxic documents and their number ``n``."""
    n = confirmed.count()
    share_p, share_u = min(1.0, positives / max(1, n)), min(1.0, others / max(1, total - n))
    chosen = confirmed.filter(uniform(F.col("doc_id"), 1) < share_p).select(F.col("doc_id").alias("_p"))
    not_other = confirmed.filter(uniform(F.col("doc_id"), 2) < share_u).select(F.col("doc_id").alias("_p"))
    texts = docs.select(F.col("doc_id").alias("_id"), "text").filter(F.col("_id").isNotNull())
    # Both lists are parts of the sample, so their size is bounded by its parameters.
    is_p = texts.join(F.broadcast(chosen), F.col("_id") == F.col("_p"), "left_semi").withColumn("positive", F.lit(True))
    rest = texts.filter(uniform(F.col("_id"), 2) < share_u)
    rest = rest.join(F.broadcast(not_other), F.col("_id") == F.col("_p"), "left_anti").withColumn("positive", F.lit(False))
    return stored(is_p.unionByName(rest), "toxicity-sample")


def feature_counts(rows: DataFrame) -> DataFrame:
    """feature, p, u: documents of the sample holding it, counted within tasks first."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[str, bool]] = Counter()

        def passed_on() -> pa.RecordBatch:
            names, sides = [f for f, _ in counts], [s for _, s in counts]
            n = list(counts.values())
            p, u = ([x if s is side else 0 for s, x in zip(sides, n, strict=True)] for side in (True, False))
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(p, pa.int64()), pa.array(u, pa.int64())], ["feature", "p", "u"])

        for batch in batches:
            for text, positive in zip(batch.column(0), batch.column(1), strict=True):
                side = positive.as_py()
                counts.update((f, side) for f in document_features(text.as_py()))
                if len(counts) >= COUNTED:
                    yield passed_on()
        yield passed_on()

    found = rows.select("text", "positive").mapInArrow(task, "feature string, p long, u long")
    return found.groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))


def fit(
    docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, others: int = UNLABELLED, held_out: bool = True
) -> Model:
    """A model from the labels outside the held-out quarter (or from all)."""
    used = labels.select(F.col("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    if held_out:
        used = used.filter(fold(F.col("doc_id"), 4) != HELD_OUT)
    used = used.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    stats = used.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("p")).first()
    if not stats["p"]:
        return Model({}, 0.0, False)
    total = docs.count()
    rows = sample(docs, used.filter("toxic = 1").select("doc_id"), positives, others, total)
    size = {r["positive"]: r["n"] for r in rows.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    n_p, n_u = size.get(True, 0), size.get(False, 0)
    if not n_p:
        return Model({}, 0.0, False)
    expected = stats["p"] / stats["n"] * total
    prior = min(0.9, max(0.005, (expected - stats["p"]) / max(1.0, total - stats["p"])))
    both = (F.col("p") + F.col("u") + 1) / (n_p + n_u + 2)
    apart = F.col("p") / n_p - F.col("u") / max(1, n_u)
    error = F.sqrt(both * (1 - both) * (1 / n_p + 1 / max(1, n_u)))
    clear = feature_counts(rows).filter((F.col("p") >= LEAST) & (apart >= ERRORS * error)).select("feature")
    vocabulary = {r["feature"]: i for i, r in enumerate(sorted(clear.collect()))}  # of a bounded sample

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [sorted(vocabulary[f] for f in document_features(t) if f in vocabulary) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(ids, pa.list_(pa.int32()))], ["key", "positive", "ids"]
            )

    key = F.xxhash64(F.col("_id"), F.lit(3)).alias("key")
    vectors = rows.select(key, "text", "positive").mapInArrow(sparse, "key long, positive boolean, ids array<int>")
    part = F.explode(F.array([F.lit(i) for i in range(PARTS)])).alias("part")
    parts = vectors.select("*", part).filter(F.pmod("key", F.lit(PARTS)) != F.col("part"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["positive", "key"])
        w = train([np.asarray(x, int) for x in pdf["ids"]], pdf["positive"].to_numpy(bool), len(vocabulary), prior)
        return pd.DataFrame({"w": [w.tolist()]})

    trained = [r["w"] for r in parts.groupBy("part").applyInPandas(one, "w array<double>").collect()]
    mean = np.mean(np.sort(np.array(trained), axis=0), axis=0)
    return Model({f: float(mean[i]) for f, i in vocabulary.items()}, float(mean[-1]))


class Scorer:
    """Scores of texts; the features of the words met last are remembered."""

    def __init__(self, model: Model):
        self.model, self.hits = model, {}

    def __call__(self, text: str | None) -> float:
        if not self.model.known:
            return 0.0
        weights, hits = self.model.weights, self.hits
        found: set[str] = set()
        for w in set(WORDS.findall((text or "").lower())):
            own = hits.get(w)
            if own is None:
                if len(hits) >= REMEMBERED:
                    hits.clear()
                own = hits[w] = tuple(f for f in features(w) if f in weights)
            if own:
                found.update(own)
        z = self.model.bias + sum(weights[f] for f in sorted(found))
        return 1 / (1 + math.exp(-max(-500.0, z)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, score (0 to 1)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            out = [scorer(v.as_py()) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(task, f"doc_id {kind}, score double")


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that the classifier doesn't call toxic, with all columns; no row is shuffled."""
    model = fit(docs, labels)
    at = docs.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            yield batch.filter(pa.array([scorer(v.as_py()) < threshold for v in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(task, docs.schema)
