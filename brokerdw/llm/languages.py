"""Language identification as a mixture: a document's words come from several languages.

Each language has a model of the letters of a word: the probability of a letter after the
two before it, smoothed towards shorter histories, from the counts of all its documents
outside the held-out quarter. A document is a mixture of languages; expectation-maximisation
estimates the proportions from the likelihoods of its words under each model. The set of
languages is the one of the highest likelihood less a penalty for every language beyond the
first; sets are the first k languages in order of their estimated proportions. The predicted
language is the largest of the chosen set; the score is its proportion times its posterior
against the languages outside the set.

A text that is null or has no letter is ``und`` with score 0, as is every text when no
language can be learned. Null languages and texts are not learned from; a null id is not
held out. Very long texts are read whole; repeated rows get the same prediction; an empty
table gives no rows; extra columns are not read. Of letter sequences the model holds the
``GRAMS`` with the largest shares, summed over languages; its size is that times the number
of languages. Words are runs of letters in lower case.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brokerdw.llm.common import stored
from brokerdw.llm.toxicity import fold

HELD_OUT = 2  # the remainder modulo 4 that is not learned from
GRAMS = 200_000
# Weight of the shorter history, in counts.
BACKOFF = 4.0
# An unseen letter is one of so many.
LETTERS = 1 << 16
# Each language beyond the first must raise the log-likelihood by so much a logarithm of the number of words, and by so much a word.
PENALTY, PER_WORD = 4.0, 0.05
ROUNDS, SETTLED = 40, 1e-4
# Distinct words that a task holds; words of documents that are looked up at once.
REMEMBERED, TOGETHER = 60_000, 40_000
WORDS = re.compile(r"[^\W\d_]+")
EDGE = "\n"


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def cut(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all words and an end each, as codes with the two before them; and the word that each belongs to."""
    text = 2 * EDGE + (2 * EDGE).join(words) + EDGE
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    edge = codes == ord(EDGE)
    # The first of two edges ends a word, the second begins the next and is not counted.
    at = np.flatnonzero(~edge[2:] | ~edge[1:-1]) + 2
    owner = np.cumsum(edge[at]) - edge[at]
    return (codes[at - 2] << 42) | (codes[at - 1] << 21) | codes[at], owner


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, gram, n: letter sequences of the words of each language, added up within the task."""
    seen: dict[str, Counter] = defaultdict(Counter)

    def passed_on() -> Iterator[pa.RecordBatch]:
        for lang, found in seen.items():
            grams, owner = cut(list(found))
            times = np.fromiter(found.values(), np.int64, len(found))
            distinct, place = np.unique(grams, return_inverse=True)
            sums = np.zeros(len(distinct), np.int64)
            np.add.at(sums, place, times[owner])
            columns = [pa.array([lang] * len(distinct), pa.string()), pa.array(distinct), pa.array(sums)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])
        seen.clear()

    entries = 0
    for batch in batches:
        for lang, text in zip(*batch.columns, strict=True):
            found = words_of(text.as_py())
            if not found:
                continue
            own = seen[lang.as_py()]
            before = len(own)
            own.update(found)
            entries += len(own) - before
            if entries >= REMEMBERED:
                yield from passed_on()
                entries = 0
    yield from passed_on()


class Table:
    """Rows of values by key; absent keys have ``default``."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, default: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values, self.default = keys[order], values[order].astype(np.float32), default.astype(np.float32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows, and whether each key is there."""
        if not len(self.keys):
            return np.tile(self.default, (len(keys), 1)), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[at] == keys
        return np.where(hit[:, None], self.values[at], self.default), hit


LOW42, LOW21 = (1 << 42) - 1, (1 << 21) - 1


@dataclass
class Model:
    """Letter models of languages; the tables hold logarithms, one column a language."""

    langs: list[str]
    chains: list[tuple[Table, Table]]  # by length of history: 2, 1, 0; each (seen sequences, weight of the shorter history)

    @staticmethod
    def build(langs: list[str], grams: np.ndarray, counts: np.ndarray) -> Model:
        """From counts of sequences of three, one row a sequence and one column a language."""

        def summed(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            distinct, place = np.unique(keys, return_inverse=True)
            sums = np.zeros((len(distinct), len(langs)))
            np.add.at(sums, place, counts)
            return distinct, sums

        shorter = np.full(len(langs), 1 / LETTERS)
        lower = None
        chains = []
        for length, mask in ((0, LOW21), (1, LOW42), (2, (1 << 63) - 1)):
            keys, n = summed(grams & mask)
            histories, whole = summed((grams & mask) >> 21 if length else grams & 0)
            own = whole[np.searchsorted(histories, keys >> 21 if length else keys & 0)]
            below = np.tile(shorter, (len(keys), 1)) if lower is None else lower(keys & (mask >> 21))
            p = (n + BACKOFF * below) / (own + BACKOFF)
            weight = BACKOFF / (whole + BACKOFF)
            known = dict(zip(keys.tolist(), p, strict=True))
            lower = lambda k, known=known: np.array([known[x] for x in k.tolist()]).reshape(len(k), len(langs))
            chains.append((Table(keys, np.log(p), np.zeros(len(langs))), Table(histories, np.log(weight), np.zeros(len(langs)))))
        return Model(langs, chains[::-1])

    def score(self, words: list[str]) -> np.ndarray:
        """The logarithm of the probability of each word in each language."""
        grams, owner = cut(words)
        total = np.zeros((len(grams), len(self.langs)))
        left = np.ones(len(grams), bool)
        for (seen, weights), mask in zip(self.chains, ((1 << 63) - 1, LOW42, LOW21), strict=True):
            at = np.flatnonzero(left)
            key = grams[at] & mask
            value, hit = seen.find(key)
            history, _ = weights.find(key >> 21 if mask != LOW21 else key & 0)
            total[at] += np.where(hit[:, None], value, history)
            left[at[hit]] = False
        total[left] -= np.log(LETTERS)
        out = np.zeros((len(words), len(self.langs)))
        np.add.at(out, owner, total)
        return out


def proportions(logs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, float]:
    """Expectation-maximisation: the shares of the columns, and the log-likelihood of the rows under them."""
    best = logs.max(1)
    likely = np.exp(logs - best[:, None])
    share = np.full(logs.shape[1], 1 / logs.shape[1])
    for _ in range(ROUNDS):
        mixed = np.maximum(likely @ share, 1e-300)
        new = share * ((times / mixed) @ likely) / times.sum()
        done = np.abs(new - share).max() < SETTLED
        share = new
        if done:
            break
    return share, float(times @ (np.log(np.maximum(likely @ share, 1e-300)) + best))


def mixture(logs: np.ndarray, times: np.ndarray) -> tuple[list[int], np.ndarray, float]:
    """The chosen languages, largest first, their proportions, and the score of the first."""
    alone = times @ logs
    cost = PENALTY * np.log1p(times.sum()) + PER_WORD * times.sum()
    first = int(alone.argmax())
    chosen, share = [first], np.ones(1)
    # No mixture is likelier than every word in its best language.
    if times @ logs.max(1) - alone[first] > cost:
        all_share, most = proportions(logs, times)
        order = np.argsort(-all_share, kind="stable")
        value = alone[first]
        for k in range(2, len(order) + 1):
            if most - cost * (k - 1) <= value:  # larger sets can't gain enough
                break
            part, reached = proportions(logs[:, order[:k]], times)
            if reached - cost * (k - 1) > value:
                value = reached - cost * (k - 1)
                rank = np.argsort(-part, kind="stable")
                chosen, share = [int(order[i]) for i in rank], part[rank]
    others = [i for i in range(len(alone)) if i not in chosen]
    against = np.exp(np.minimum(alone[others] - alone[chosen[0]], 0)).sum()
    return chosen, share, float(share[0] / (1 + against))


def fit(docs: DataFrame, grams: int = GRAMS, held_out: bool = True) -> Model:
    """Letter models from the documents with a language outside the held-out quarter (or from all)."""
    used = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if held_out:
        used = used.filter(~is_held_out(F.col("doc_id")))
    counted = used.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(_count, "lang string, gram long, n long")
    rows = stored(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "languages-counts")
    sizes = rows.groupBy("lang").agg(F.sum("n").alias("whole"))
    share = rows.join(F.broadcast(sizes), "lang").groupBy("gram").agg(F.sum(F.col("n") / F.col("whole")).alias("share"))
    kept = share.orderBy(F.desc("share"), "gram").limit(grams).select("gram")
    # One row a kept sequence and language, which is what the model holds.
    found = rows.join(F.broadcast(kept), "gram").select("lang", "gram", "n").toPandas().sort_values(["lang", "gram"])
    langs = sorted(set(found["lang"]))
    keys = np.unique(found["gram"].to_numpy(np.int64))
    counts = np.zeros((len(keys), len(langs)))
    column = found["lang"].map({name: i for i, name in enumerate(langs)}).to_numpy(int)
    counts[np.searchsorted(keys, found["gram"].to_numpy(np.int64)), column] = found["n"].to_numpy(float)
    return Model.build(langs, keys, counts)


class Identifier:
    """Mixtures of texts; the likelihoods of the words met last are remembered."""

    def __init__(self, model: Model):
        self.model, self.place, self.rows = model, {}, np.zeros((0, len(model.langs)))

    def _look_up(self, found: list[dict[str, int]]) -> None:
        if len(self.place) > REMEMBERED:
            self.place, self.rows = {}, self.rows[:0]
        new = list(dict.fromkeys(w for words in found for w in words if w not in self.place))
        if new:
            self.rows = np.concatenate([self.rows, self.model.score(new)])
            self.place.update(zip(new, range(len(self.place), len(self.rows)), strict=True))

    def _together(self, found: list[dict[str, int]]) -> Iterator[tuple[list[str], list[float], float]]:
        self._look_up(found)
        for words in found:
            if not words or not self.model.langs:
                yield [], [], 0.0
                continue
            at = np.fromiter((self.place[w] for w in words), np.int64, len(words))
            times = np.fromiter(words.values(), float, len(words))
            chosen, share, score = mixture(self.rows[at], times)
            yield [self.model.langs[i] for i in chosen], share.tolist(), score

    def __call__(self, texts: Iterator[str | None]) -> Iterator[tuple[list[str], list[float], float]]:
        """Languages (largest first), proportions and score of each text."""
        waiting, size = [], 0
        for text in texts:
            # Some characters count as part of a word, but are no letters.
            words = {w: n for w, n in Counter(words_of(text)).items() if w.isalpha() or any(map(str.isalpha, w))}
            waiting.append(words)
            size += len(words)
            if size >= TOGETHER:
                yield from self._together(waiting)
                waiting, size = [], 0
        yield from self._together(waiting)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id, 4) == HELD_OUT, F.lit(False))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, lang_pred, score, langs (the chosen set, largest first), shares (their proportions)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = Identifier(model)
        for batch in batches:
            out = list(identifier(v.as_py() for v in batch.column(1)))
            columns = [
                batch.column(0),
                pa.array([o[0][0] if o[0] else "und" for o in out], pa.string()),
                pa.array([o[2] for o in out], pa.float64()),
                pa.array([o[0] for o in out], pa.list_(pa.string())),
                pa.array([o[1] for o in out], pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "langs", "shares"])

    schema = f"doc_id {kind}, lang_pred string, score double, langs array<string>, shares array<double>"
    return docs.select("doc_id", "text").mapInArrow(task, schema)
