"""Katz backoff language model: discounted n-gram counts with exactly normalised backoff weights.

A word after a context h has probability d(c) c / (c(h) + 1) if it was seen there c times,
and alpha(h) times its probability after the shorter context if not. d follows Good and
Turing for counts up to ``CUT`` (half a count is taken off where their estimate is not
between 0 and 1); the one added to c(h) leaves every context some mass to back off with.
alpha(h) = (1 - sum of seen probabilities) / (1 - sum of the seen words' probabilities
after the shorter context), so that the probabilities after h sum to 1. All words never
seen count as one event at the lowest order.

The corpus is cut into chunks of documents. A chunk asks the tables of counts once for each
of its distinct n-grams, as sorted 56-bit hashes, and gets the counts back in that order; the
tables are dealt by hash, so a frequent word or context is no heavier than others. Of the
chunks that hold a seen n-gram one owns it and adds its probability to its context's sums.
Only n-grams of held-out texts can be unseen, so only these ask for backoff weights, and the
sums of a context that no held-out text holds are not sent. The orders are counted one after
the other, chunks are scored and contexts weighed in ``ROUNDS`` shares, each stored before the
next: what a job shuffles is on disk for a share of the corpus at a time.

A text is its lower-cased (A-Z) words and one end. Nulls and empty texts have the end alone;
long texts are read whole; repeated rows, and rows without an id, are texts of their own;
without training texts every score is 0. An empty table gives no rows. Extra columns are
not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brokerdw.llm.common import stored
from brokerdw.session import scratch_dir, write_parquet

ORDER = 2
CUT = 5
KEY_BITS = 56
# Tokens after which a chunk is closed, and tokens per part of the count tables.
CHUNK_TOKENS, PART_TOKENS = 1_200_000, 1_500_000
# Parts of the count tables that make one part of the contexts: those that held-out texts hold are fewer.
MERGED = 4
# Shares in which chunks are scored and contexts weighed.
ROUNDS = 6
END, BEGIN = b"\n", b" "  # no words
PARTS_OF, HELD_OUT = 7, 2

CHUNKS = "chunk long, docs int, lengths binary, train binary, words binary, tokens binary, n long, train_docs long, ids array<{}>"
COUNTS = "kind string, ord int, part int, chunk long, keys binary, counts binary, stats array<long>"


def pack(a: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, compressed."""
    a = np.ascontiguousarray(a)
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())


def unpack(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).view(kind).ravel()


def pack_sorted(a: np.ndarray) -> bytes:
    """Differences wrap around, so runs of sorted values will do."""
    return pack(np.diff(a, prepend=a.dtype.type(0)))


def unpack_sorted(data: bytes, kind: type) -> np.ndarray:
    return np.cumsum(unpack(data, kind), dtype=kind)


def pack_floats(a: np.ndarray) -> bytes:
    """Positive numbers of which many are equal: the distinct ones, and for each number its place among them."""
    distinct, at = np.unique(a, return_inverse=True)
    head = pack_sorted(distinct.view(np.uint64))
    return len(head).to_bytes(4, "little") + head + pack(at.astype(np.uint32))


def unpack_floats(data: bytes) -> np.ndarray:
    end = 4 + int.from_bytes(data[:4], "little")
    return unpack_sorted(data[4:end], np.uint64).view(np.float64)[unpack(data[end:], np.uint32)]


def held_out(doc_id: Column) -> Column:
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % PARTS_OF
    return F.coalesce(remainder == HELD_OUT, F.lit(False))


class Numbers(dict):
    """Numbers in order of appearance."""

    def __missing__(self, key: bytes) -> int:
        self[key] = n = len(self)
        return n


def chunks(docs: DataFrame) -> DataFrame:
    """Documents as word numbers, some millions of words a row."""

    def close(numbers: Numbers, tokens: list, lengths: list, train: list, ids: list, at: int) -> pa.RecordBatch:
        from pyspark import TaskContext

        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in numbers), np.uint64, len(numbers))
        tokens = np.concatenate(tokens)
        # Words by falling count, and by hash where these are equal, take less room.
        by_count = np.lexsort((hashes, -np.bincount(tokens, minlength=len(hashes))))
        rank = np.empty(len(hashes), np.uint32)
        rank[by_count] = np.arange(len(hashes), dtype=np.uint32)
        values = [
            (TaskContext.get().partitionId() << 32) + at,
            len(lengths),
            pack(np.array(lengths, np.uint32)),
            pack(np.array(train, np.uint8)),
            pack_sorted(hashes[by_count]),
            pack(rank[tokens]),
            sum(lengths),
            sum(train),
        ]
        types = [pa.int64(), pa.int32(), *[pa.binary()] * 4, pa.int64(), pa.int64()]
        columns = [pa.array([v], t) for v, t in zip(values, types, strict=True)]
        columns.append(pa.ListArray.from_arrays(pa.array([0, len(lengths)], pa.int32()), pa.concat_arrays(ids)))
        return pa.RecordBatch.from_arrays(
            columns, ["chunk", "docs", "lengths", "train", "words", "tokens", "n", "train_docs", "ids"]
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, size = 0, 0
        numbers, tokens, lengths, train, ids = Numbers(), [], [], [], []
        for batch in batches:
            start = 0
            for i in range(batch.num_rows):
                words = (batch.column(1)[i].as_py() or "").encode("utf-8").lower().split()
                words.append(END)
                tokens.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
                lengths.append(len(words))
                train.append(int(batch.column(2)[i].as_py()))
                size += len(words)
                if size >= CHUNK_TOKENS or i == batch.num_rows - 1:
                    ids.append(batch.column(0).slice(start, i + 1 - start))
                    start = i + 1
                if size >= CHUNK_TOKENS:
                    yield close(numbers, tokens, lengths, train, ids, at)
                    at, size = at + 1, 0
                    numbers, tokens, lengths, train, ids = Numbers(), [], [], [], []
        if lengths:
            yield close(numbers, tokens, lengths, train, ids, at)

    kind = docs.schema["doc_id"].dataType.simpleString()
    train = ~held_out(F.col("doc_id"))
    return docs.select("doc_id", "text", train.alias("train")).mapInArrow(task, CHUNKS.format(kind))


class Chunk:
    """A chunk's texts: for every token its word, its text and its place in it."""

    def __init__(self, lengths: bytes, train: bytes, words: bytes, tokens: bytes):
        self.lengths = unpack(lengths, np.uint32).astype(np.int64)
        self.train = unpack(train, np.uint8).astype(bool)
        self.word = unpack_sorted(words, np.uint64)[unpack(tokens, np.uint32)]
        self.doc = np.repeat(np.arange(len(self.lengths), dtype=np.int32), self.lengths)
        starts = np.cumsum(self.lengths) - self.lengths
        self.place = (np.arange(len(self.word)) - starts[self.doc]).astype(np.int32)

    def grams(self, k: int) -> np.ndarray:
        """The key of the n-gram of order k that ends at each token."""
        begin = np.uint64(xxhash.xxh3_64_intdigest(BEGIN))
        g = np.full(len(self.word), k, np.uint64)
        for back in range(k - 1, -1, -1):
            g ^= np.where(self.place >= back, np.roll(self.word, back), begin) if back else self.word
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                g ^= g >> np.uint64(shift)
                g *= np.uint64(factor)
            g ^= g >> np.uint64(31)
        g >>= np.uint64(64 - KEY_BITS)
        return g


def part_bounds(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each part's keys begin in sorted ``keys``; a part is a range of hashes."""
    edges = [-(-(i << KEY_BITS) // parts) for i in range(1, parts)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(edges, np.uint64)), [len(keys)]]).astype(int)


def asks(table: DataFrame, k: int, parts: int) -> DataFrame:
    """Per chunk and part: the distinct n-grams' keys of order ``k``; twice their number in training texts, plus 1 if held-out ones hold them."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                c = Chunk(row["lengths"], row["train"], row["words"], row["tokens"])
                keys, at = np.unique(c.grams(k), return_inverse=True)
                train = c.train[c.doc]
                counts = 2 * np.bincount(at, train, len(keys)).astype(np.uint32)
                counts += np.bincount(at, ~train, len(keys)) > 0
                bounds = part_bounds(keys, parts)
                out = [
                    (k, p, row["chunk"], pack_sorted(keys[a:b]), pack(counts[a:b]))
                    for p, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))
                    if b > a
                ]
                columns = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), ASK_TYPES, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["ord", "part", "chunk", "keys", "counts"])

    schema = "ord int, part int, chunk long, keys binary, counts binary"
    return table.select("chunk", "lengths", "train", "words", "tokens").mapInArrow(task, schema)


ASK_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]


def count_part(pdf: pd.DataFrame) -> pd.DataFrame:
    """One part of the table of counts, and the answer to each chunk.

    That is four times the count, plus 2 if a held-out text holds the n-gram, plus 1 for its owner.
    """
    pdf = pdf.sort_values("chunk")
    order, part = int(pdf["ord"].iloc[0]), int(pdf["part"].iloc[0])
    keys = [unpack_sorted(b, np.uint64) for b in pdf["keys"]]
    distinct, first, at = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    counts = np.concatenate([unpack(b, np.uint32) for b in pdf["counts"]])
    total = np.bincount(at, counts >> np.uint32(1), len(distinct)).astype(np.int64)
    held = np.bincount(at, counts & np.uint32(1), len(distinct)) > 0
    answer = (4 * total + 2 * held)[at]
    answer[first] += 1
    ends = np.cumsum([len(k) for k in keys])
    rows = [
        ("answer", order, part, chunk, None, pack(a.astype(np.uint64)), None)
        for chunk, a in zip(pdf["chunk"], np.split(answer, ends[:-1]), strict=True)
    ]
    seen = total > 0
    often = np.bincount(np.minimum(total, CUT + 2), minlength=CUT + 3)
    stats = [int(total.sum()), int(seen.sum()), *(int(often[r]) for r in range(1, CUT + 2))]
    rows.append(("count", order, part, None, pack_sorted(distinct[seen]), pack(total[seen].astype(np.uint64)), stats))
    return pd.DataFrame(rows, columns=["kind", "ord", "part", "chunk", "keys", "counts", "stats"])


def discounts(often: list[int]) -> np.ndarray:
    """d(0..CUT + 1) from the numbers of n-grams seen 1 to CUT + 1 times."""
    d = np.ones(CUT + 2)
    n = [0, *often]
    top = (CUT + 1) * n[CUT + 1] / n[1] if n[1] else 1.0
    for r in range(1, CUT + 1):
        good = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
        value = (good - top) / (1 - top) if top < 1 else 0.0
        d[r] = value if 0 < value < 1 else (r - 0.5) / r
    return d


class Model:
    """The few numbers that every text needs: totals and discounts of each order."""

    def __init__(self, stats: dict[int, list[int]], train_docs: int, order: int):
        blank = [0] * (CUT + 3)
        self.order, self.train_docs = order, train_docs
        self.tokens, self.types = stats.get(1, blank)[:2]
        self.d = [discounts(stats.get(k, blank)[2:]) for k in range(1, order + 1)]
        often = stats.get(1, blank)[2 : 2 + CUT]
        small = sum(r * n for r, n in enumerate(often, 1))
        known = sum(self.d[0][r] * r * n for r, n in enumerate(often, 1)) + self.tokens - small
        self.unknown = 1 - known / (self.tokens + 1)

    def seen(self, k: int, counts: np.ndarray, context: np.ndarray | int) -> np.ndarray:
        """Probabilities of n-grams of order k seen ``counts`` times after contexts seen ``context`` times."""
        return self.d[k - 1][np.minimum(counts, CUT + 1)] * counts / (context + 1.0)


def score_chunk(c: Chunk, answers: Iterable[np.ndarray], m: Model, parts: int) -> tuple[dict[str, np.ndarray], list, list]:
    """Per document what is known without backoff weights; each context's sums; the weights asked for.

    The orders are taken one after the other; of the one before only its keys, counts and probabilities are kept.
    """
    add = lambda v: np.bincount(c.doc, v, len(c.lengths))
    first = c.place == 0
    begin = np.uint64((1 << KEY_BITS) - 1)  # key of the empty context before a text, the same in every order
    docs, sums = {"n_tokens": c.lengths}, []
    score = np.empty(0)
    asked: list[tuple[np.ndarray, np.ndarray]] = []  # by order, the tokens that need a weight and the keys of their contexts
    grams = here = p = held = None  # of the order before
    for k, answer in enumerate(answers, 1):
        g = c.grams(k)
        by_gram = np.argsort(g, kind="stable")
        s = g[by_gram]
        starts = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        del s
        times = np.diff(starts, append=len(g))
        # A token that stands for each n-gram owned here.
        own = by_gram[starts[((answer & np.uint64(1)) == 1) & (answer >= 4)]]
        count = np.empty(len(g), np.int64)
        count[by_gram] = np.repeat((answer >> np.uint64(2)).astype(np.int64), times)
        holds = np.empty(len(g), bool)
        holds[by_gram] = np.repeat((answer & np.uint64(2)) > 0, times)
        del by_gram, starts, times
        if k == 1:
            new = np.where(count > 0, m.seen(1, count, m.tokens), m.unknown)
            score = np.log10(new)
            docs |= {"n_known": add(count > 0).astype(int), "base_score": add(np.log10((count + 1.0) / (m.tokens + m.types + 1.0)))}
        else:
            context = np.where(first, m.train_docs, np.roll(here, 1))
            new = np.where(count > 0, m.seen(k, count, context), 0.0)
            score[count > 0] = np.log10(new[count > 0])
            unseen = np.flatnonzero((context > 0) & (count == 0))
            del context
            keys = np.where(first, begin, np.roll(grams, 1))
            asked = [(at[count[at] == 0], h[count[at] == 0]) for at, h in asked] + [(unseen, keys[unseen])]
            # The sums of contexts that held-out texts hold.
            own = own[first[own] | np.roll(held, 1)[own]]
            names, at = np.unique(keys[own], return_inverse=True)
            del keys
            a, b = np.bincount(at, new[own], len(names)), np.bincount(at, p[own], len(names))
            bounds = part_bounds(names, parts)
            for i, (x, y) in enumerate(zip(bounds, bounds[1:], strict=False)):
                if y > x:
                    sums.append((k, i, pack_sorted(names[x:y]), pack_floats(a[x:y]), pack_floats(b[x:y])))
            del names, at, a, b
        grams, here, p, held = g, count, new, holds
        del g, own, count, new, holds
    wanted = []
    for k, (at, keys) in enumerate(asked, 2):
        by_key = np.argsort(keys, kind="stable")
        keys, doc = keys[by_key], c.doc[at[by_key]].astype(np.uint32)
        bounds = part_bounds(keys, parts)
        for i, (x, y) in enumerate(zip(bounds, bounds[1:], strict=False)):
            if y > x:
                wanted.append((k, i, pack_sorted(keys[x:y]), pack(doc[x:y]), None))
    return docs | {"score": add(score)}, sums, wanted


RESULT = "held_out boolean, n_tokens long, n_known long, base_score double, score double"
SCORED = f"ord int, part int, chunk long, doc int, keys binary, a binary, b binary, {RESULT}"
WEIGHED, ADDED = "chunk long, docs binary, change binary", "chunk long, doc int, score double"


def weigh_part(pdf: pd.DataFrame) -> pd.DataFrame:
    """Backoff weights of one part of the contexts, summed up per document that asked for them, a row a chunk."""
    pdf = pdf.sort_values("chunk")
    give, ask = pdf[pdf["b"].notna()], pdf[pdf["b"].isna()]
    out = []
    if len(give) and len(ask):
        names, at = np.unique(np.concatenate([unpack_sorted(b, np.uint64) for b in give["keys"]]), return_inverse=True)
        a = np.bincount(at, np.concatenate([unpack_floats(x) for x in give["a"]]), len(names))
        b = np.bincount(at, np.concatenate([unpack_floats(x) for x in give["b"]]), len(names))
        alpha = np.log10(np.maximum(1 - a, 1e-300) / np.maximum(1 - b, 1e-300))
        for row in ask.itertuples(index=False):
            keys, doc = unpack_sorted(row.keys, np.uint64), unpack(row.a, np.uint32)
            docs, back = np.unique(doc, return_inverse=True)
            change = np.bincount(back, alpha[np.searchsorted(names, keys)], len(docs))
            out.append((row.chunk, pack_sorted(docs), pack(change)))
    return pd.DataFrame(out, columns=["chunk", "docs", "change"])


def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
    """The changes of one chunk's documents."""
    docs, at = np.unique(np.concatenate([unpack_sorted(x, np.uint32) for x in pdf["docs"]]), return_inverse=True)
    change = np.bincount(at, np.concatenate([unpack(x, np.float64) for x in pdf["change"]]), len(docs))
    return pd.DataFrame({"chunk": pdf["chunk"].iloc[0], "doc": docs.astype(int), "score": change})


def score(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    The model learns from the rows that are not held out. Its tables stay in the shared
    folder: counts by order and part.
    """
    spark = docs.sparkSession
    table = stored(chunks(docs), "lm-chunks")
    size = table.agg(F.sum("n").alias("n"), F.sum("train_docs").alias("d")).first()
    parts = max(1, math.ceil((size["n"] or 0) / PART_TOKENS))
    path = scratch_dir(spark, "lm-counts")
    for k in range(1, order + 1):
        counted = asks(table, k, parts).groupBy("ord", "part").applyInPandas(count_part, COUNTS)
        write_parquet(counted.drop("ord"), f"{path}/ord={k}", ["kind"])
    counts = spark.read.schema(COUNTS).parquet(path)
    totals = counts.filter("kind = 'count'").groupBy("ord").agg(
        *[F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(CUT + 3)]
    )
    stats = {r["ord"]: [r[f"s{i}"] for i in range(CUT + 3)] for r in totals.collect()}  # one row per order
    model = Model(stats, size["d"] or 0, order)
    names = ["held_out", "n_tokens", "n_known", "base_score", "score"]

    def one(chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = chunk.iloc[0]
        c = Chunk(row["lengths"], row["train"], row["words"], row["tokens"])
        answers = answers.sort_values(["ord", "part"])
        replies = (
            np.concatenate([unpack(b, np.uint64) for b in answers["counts"][answers["ord"] == k]]) for k in range(1, order + 1)
        )
        found, sums, wanted = score_chunk(c, replies, model, math.ceil(parts / MERGED))
        per_doc = pd.DataFrame({"doc": np.arange(len(c.lengths)), "held_out": ~c.train, **found})
        rest = pd.DataFrame([*sums, *wanted], columns=["ord", "part", "keys", "a", "b"])
        out = pd.concat([per_doc.assign(ord=0, part=int(row["chunk"] % 1009)), rest])
        return out.assign(chunk=row["chunk"]).reindex(columns=["ord", "part", "chunk", "doc", "keys", "a", "b", *names])

    columns = table.select("chunk", "lengths", "train", "words", "tokens")
    answers = counts.filter("kind = 'answer'").select("chunk", "ord", "part", "counts")
    turn = F.when(F.col("ord") == 0, -1).otherwise(F.col("part") % ROUNDS)
    path = scratch_dir(spark, "lm-scored")
    for i in range(ROUNDS):
        mine = [t.filter(F.pmod(F.xxhash64("chunk"), F.lit(ROUNDS)) == i).groupBy("chunk") for t in (columns, answers)]
        scored = mine[0].cogroup(mine[1]).applyInPandas(one, SCORED)
        write_parquet(scored.withColumn("turn", turn), f"{path}/round={i}", ["turn"])
    scored = spark.read.schema(f"{SCORED}, round int, turn int").parquet(path)
    path = scratch_dir(spark, "lm-weights")
    for i in range(ROUNDS):
        asked = scored.filter(F.col("turn") == i).select("ord", "part", "chunk", "keys", "a", "b")
        weighed = asked.groupBy("ord", "part").applyInPandas(weigh_part, WEIGHED)
        write_parquet(weighed.groupBy("chunk").applyInPandas(add_up, ADDED), f"{path}/turn={i}")
    weighed = spark.read.schema(f"{ADDED}, turn int").parquet(path).drop("turn")
    every = scored.filter("turn = -1").select("chunk", "doc", *names).unionByName(weighed, allowMissingColumns=True)
    whole = every.groupBy("chunk", "doc").agg(
        *[F.first(n, ignorenulls=True).alias(n) for n in names[:4]], F.sum("score").alias("score")
    )
    # The ids do not pass through pandas, where a column with missing values is one of floats.
    ids = table.select("chunk", F.posexplode("ids").alias("doc", "doc_id"))
    whole = whole.join(ids, ["chunk", "doc"])
    return whole.select("doc_id", *names[:3], F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
