"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Equal vectors are indexed once, with their smallest ids. Distinct vectors are dealt to
shards by hash, so a shard has about ``SHARD_ROWS`` vectors whatever the input. A shard's
graph is one row of flat arrays: the vectors, for each layer its nodes and a matrix of
neighbours. Queries go in blocks to every shard; the shards' results are merged.

Vectors that are null, empty, zero or hold null or non-finite components take no part,
neither as queries nor as results; vectors of another length are no candidates. Rows that
repeat an id and vector count once; nulls as ids take no part; an empty table gives no
rows; extra columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brokerdw.llm.common import stored

SHARD_ROWS = 4_096
BLOCK_QUERIES = 256
# Links per node and layer (twice as many on the lowest), nearest nodes considered for them, search width.
LINKS, CONSIDERED, WIDTH = 16, 64, 160
SEED = 11

INDEX = "shard int, dim int, vectors binary, ids array<array<long>>, nodes array<binary>, links array<binary>"


def usable(v: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False))


def diverse(near: np.ndarray, apart: np.ndarray, most: int) -> list[int]:
    """Of candidates in order of distance: each that is closer to the node than to those kept before."""
    kept: list[int] = []
    for i in range(len(near)):
        if not kept or (apart[i, kept] > near[i]).all():
            kept.append(i)
            if len(kept) == most:
                break
    for i in range(len(near)):  # then the nearest of the others
        if len(kept) >= most:
            break
        if i not in kept:
            kept.append(i)
    return kept


def build(v: np.ndarray, seed: int) -> tuple[list[bytes], list[bytes]]:
    """Layers from the lowest: node numbers, and per node its neighbours as places in the layer (-1: none).

    Nodes come one after the other; each links to diverse nearest nodes that came before
    it on its layers, and these link back; lists that grow too long are thinned out.
    """
    n = len(v)
    rng = np.random.default_rng(SEED + seed)
    levels = np.minimum((-np.log(1 - rng.random(n)) / math.log(LINKS)).astype(int), 12)
    nodes, links = [], []
    for level in range(int(levels.max(initial=0)) + 1):
        members = np.flatnonzero(levels >= level)
        x = v[members]
        square = (x * x).sum(1)
        most = LINKS * (2 if level == 0 else 1)
        lists: list[list[int]] = [[] for _ in members]

        def distances(i: int, to: np.ndarray, x=x, square=square) -> np.ndarray:
            return square[to] + square[i] - 2 * (x[to] @ x[i])

        for start in range(0, len(members), 512):  # distances to all earlier nodes, a block at a time
            stop = min(start + 512, len(members))
            block = square[None, :stop] + square[start:stop, None] - 2 * (x[start:stop] @ x[:stop].T)
            for i in range(max(start, 1), stop):
                row = block[i - start, :i]
                near = np.argpartition(row, CONSIDERED)[:CONSIDERED] if i > CONSIDERED else np.arange(i)
                near = near[np.argsort(row[near], kind="stable")]
                y = x[near]
                apart = square[near][:, None] + square[near][None, :] - 2 * (y @ y.T)
                for j in near[diverse(row[near], apart, LINKS)]:
                    lists[i].append(int(j))
                    lists[j].append(i)
        flat = np.full((len(members), most), -1, np.int32)
        for i, found in enumerate(lists):
            to = np.array(found, int)
            if len(to) > most:
                d = distances(i, to)
                order = np.argsort(d, kind="stable")
                to, d = to[order], d[order]
                y = x[to]
                apart = square[to][:, None] + square[to][None, :] - 2 * (y @ y.T)
                to = to[diverse(d, apart, most)]
            flat[i, : len(to)] = to
        nodes.append(members.astype(np.int32).tobytes())
        links.append(flat.tobytes())
    return nodes, links


class Graph:
    """A shard's index, for searching."""

    def __init__(self, dim: int, vectors: bytes, nodes: list[bytes], links: list[bytes]):
        self.v = np.frombuffer(vectors, np.float64).reshape(-1, dim)
        self.nodes = [np.frombuffer(b, np.int32) for b in nodes]
        self.links = [np.frombuffer(b, np.int32).reshape(len(n), -1) for b, n in zip(links, self.nodes, strict=True)]
        self.place = [{int(x): i for i, x in enumerate(n)} for n in self.nodes[1:]]

    def search(self, q: np.ndarray, k: int, width: int) -> list[tuple[float, int]]:
        """(squared distance, vector) of the k nearest found, nearest first."""
        at = int(self.nodes[-1][0])
        best = float(((self.v[at] - q) ** 2).sum())
        for level in range(len(self.nodes) - 1, 0, -1):
            moved = True
            while moved:
                moved = False
                to = self.links[level][self.place[level - 1][at]]
                to = self.nodes[level][to[to >= 0]]
                if len(to):
                    d = ((self.v[to] - q) ** 2).sum(1)
                    i = int(d.argmin())
                    if d[i] < best:
                        best, at, moved = float(d[i]), int(to[i]), True
        seen = np.zeros(len(self.v), bool)
        seen[at] = True
        open_, found = [(best, at)], [(-best, at)]
        while open_:
            d, at = heapq.heappop(open_)
            if d > -found[0][0] and len(found) >= width:
                break
            to = self.links[0][at]
            to = to[to >= 0]
            to = to[~seen[to]]
            seen[to] = True
            ds = ((self.v[to] - q) ** 2).sum(1)
            for x, i in zip(ds.tolist(), to.tolist(), strict=True):
                if len(found) < width:
                    heapq.heappush(found, (-x, i))
                    heapq.heappush(open_, (x, i))
                elif x < -found[0][0]:
                    heapq.heapreplace(found, (-x, i))
                    heapq.heappush(open_, (x, i))
        return sorted((-d, i) for d, i in found)[:k]


def build_index(vectors: DataFrame, copies: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A stored table with one graph a row, from ``vec_id, embedding``; of equal vectors the ``copies`` smallest ids stay."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("v")))
    # The rank is limited before the shuffle too, so a very frequent vector sends few rows.
    first = F.dense_rank().over(Window.partitionBy("v").orderBy("vec_id"))
    distinct = rows.withColumn("_r", first).filter(F.col("_r") <= copies).groupBy("v").agg(
        F.array_sort(F.collect_set("vec_id")).alias("ids")
    )
    distinct = stored(distinct, "hnsw-vectors")
    shards = max(1, math.ceil(distinct.count() / shard_rows))
    dealt = distinct.withColumn("dim", F.size("v")).withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.array(pdf["v"].tolist(), np.float64)
        order = np.lexsort(v.T)  # the same graph whatever the order of arrival
        order = np.random.default_rng(SEED).permutation(order)
        nodes, links = build(v[order], int(pdf["shard"].iloc[0]))
        ids = [list(map(int, x)) for x in pdf["ids"].iloc[order]]
        row = [pdf["shard"].iloc[0], v.shape[1], v[order].tobytes(), ids, nodes, links]
        return pd.DataFrame([row], columns=["shard", "dim", "vectors", "ids", "nodes", "links"])

    return stored(dealt.groupBy("shard", "dim").applyInPandas(one, INDEX), "hnsw-graphs")


def search(queries: DataFrame, index: DataFrame, k: int, width: int = WIDTH) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other rows found for each row of ``vec_id, embedding``."""
    q = queries.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    q = q.filter(F.col("vec_id").isNotNull() & usable(F.col("v"))).distinct().withColumn("dim", F.size("v"))
    blocks = max(1, math.ceil(q.count() / BLOCK_QUERIES))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block")
    packed = q.groupBy("dim", block).agg(F.collect_list(F.struct("vec_id", "v")).alias("queries"))
    shards = index.groupBy("dim").agg(F.collect_set("shard").alias("shards"))
    sent = packed.join(shards, "dim").withColumn("shard", F.explode("shards")).drop("shards")
    met = sent.join(index, ["dim", "shard"])

    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, graph = None, None
        for frame in frames:
            for row in frame.itertuples(index=False):
                if (row.dim, row.shard) != last:
                    last = (row.dim, row.shard)
                    graph = Graph(row.dim, row.vectors, list(row.nodes), list(row.links))
                out = []
                for x in row.queries:
                    v = np.array(x["v"], np.float64)
                    for d, i in graph.search(v, k + 1, width):
                        out += [(x["vec_id"], int(c), math.sqrt(d)) for c in row.ids[i] if c != x["vec_id"]]
                yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    columns = met.select("dim", "shard", "vectors", "ids", "nodes", "links", "queries")
    found = columns.mapInPandas(task, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
