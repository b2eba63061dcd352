"""Mixing, sharding, toxicity, neighbours and the pipeline."""

import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brokerdw.llm import hnsw, mixing, shards, toxicity
from brokerdw.llm.queries import MIX_SQL, QUERIES, SHARD_SQL

from .conftest import texts

SF = "/root/testdata/sf0.01"


def test_mix_meets_targets(odd, documents):
    for df in (odd, documents):
        rows = mixing.mix(df).collect()
        assert len(rows) == df.count() and all(r["taken"] <= 3 * r["size"] for r in rows)
        taken = Counter()
        for r in rows:
            taken[r["source_size"], r["target"]] += r["taken"]
        assert all(abs(n - t) <= 1 * sum(1 for x in taken if x[1] == t) for (_, t), n in taken.items())
        assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mixing.mix(df).collect()), key=repr)


def test_mix_shares_the_excess(spark):
    sizes = {"a": 10, "b": 100, "c": 400, None: 90}  # weights 5, 2, 1, 5
    docs = [(i, "w " * 10, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n // 10))]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = mixing.mix(df).join(df.select("doc_id", "source"), "doc_id").select("source", "target").distinct().collect()
    assert {r["source"]: round(r["target"], 6) for r in rows} == {"a": 30.0, None: 270.0, "b": 200.0, "c": 100.0}


def test_mix_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    want = sorted((a, b, c, round(d, 6), e) for a, b, c, d, e in con.sql(MIX_SQL).fetchall())
    got = QUERIES["op6_mixing"](spark, SF).collect()
    assert sorted((r[0], r[1], r[2], round(r[3], 6), r[4]) for r in got) == want


def test_repeated_rows_at_the_cut_are_mixed_one_by_one(spark):
    """Five equal rows of 4 words and a target of 16 words: three come once, one not at all."""
    rows = [(7, "a b c d", "s")] * 5 + [(i, "w " * 10, "t") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    targets = {r["source_size"]: r["target"] for r in mixing.mix(df).collect()}
    for weights in ((1, 2), (1, 9), (2, 1), (7, 3)):
        taken = {r["source_size"]: r["target"] for r in mixing.mix(df, weights).collect()}
        got = mixing.mixed_documents(df, weights).filter("source = 's'").count()
        assert abs(4 * got - taken[20]) <= 2, (weights, got, taken)
    assert targets


def test_shards_equal_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    rel = con.sql(SHARD_SQL)
    got = QUERIES["op8_sharding"](spark, SF).select(*rel.columns).collect()
    assert sorted(map(tuple, got)) == sorted(rel.fetchall())


def test_mixed_documents(odd, empty):
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns and mixing.mixed_documents(empty).count() == mixing.mix(empty).count() == 0
    times = Counter(r["doc_id"] for r in out.collect())
    assert times[4] == times[5] == 1 and max(times.values()) <= 6


def test_shards_hold_the_mixture(documents):
    docs = {r["doc_id"]: r for r in documents.collect()}
    rows = shards.assign_shards(documents).collect()
    per = Counter(r["shard"] for r in rows)
    assert set(per) == set(range(16)) and max(per.values()) - min(per.values()) <= 1
    for s in per:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(per[s]))
    sources = Counter(d["source"] for d in docs.values())
    for (_, source), n in Counter((r["shard"], docs[r["doc_id"]]["source"]) for r in rows).items():
        assert abs(n - sources[source] / 16) < 2
    for r in rows:
        b = (docs[r["doc_id"]]["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(b) + 1, zlib.crc32(b), "rows", None)


def test_shards_of_odd_rows(odd, empty):
    rows = shards.assign_shards(odd).collect()
    assert len(rows) == odd.count() and shards.assign_shards(empty).count() == 0
    per = Counter(r["shard"] for r in rows)
    assert max(per.values()) == 1 and {r["size"] for r in rows if r["doc_id"] in (4, 5)} == {1}


@pytest.fixture(scope="module")
def scored(spark):
    rows = QUERIES["op9_toxicity"](spark, "/root/testdata/sf0.1").collect()
    return {r["doc_id"]: r for r in rows}


def test_toxicity_on_held_out_labels(spark, scored):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    held = [i for i in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(scored[i]["held_out"] for i in held) and len(scored) == 10_000
    pos = np.array([scored[i]["score"] for i in held if labels[i]])
    neg = np.array([scored[i]["score"] for i in held if not labels[i]])
    assert (pos[:, None] > neg[None, :]).mean() > 0.93
    assert (pos >= 0.3).mean() > 0.85 and (neg >= 0.3).mean() < 0.05
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in scored.values())


def test_toxicity_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame(
        [(i, x) for i, x in ((1, 0), (2, 0), (1 << 40, 1), (None, 1), (99, None), (77, 1), (12, 0))], "doc_id long, toxic int"
    )
    none = labels.filter("false")
    for used in (labels, none):
        rows = toxicity.score(odd, toxicity.fit(odd, used)).collect()
        assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert len({r["score"] for r in rows if r["doc_id"] in (4, 5, 6)}) == 1
    assert all(r["score"] == 0 for r in rows)
    kept = toxicity.clean_documents(odd, none)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert toxicity.clean_documents(empty, labels).count() == 0


def nearest(vectors, k, every):
    out = []
    for q, v in vectors:
        if q % every:
            continue
        near = sorted((math.dist(v, w), i) for i, w in vectors if i != q)[:k]
        out += [(q, r, i, d) for r, (d, i) in enumerate(near, 1)]
    return out


def test_neighbours_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = [(r["vec_id"], np.array(r["embedding"], float)) for r in df.collect()]
    got = QUERIES["op10_hnsw"](spark, "/root/testdata/sf0.1").collect()
    want = nearest(vectors, 10, 100)
    found = {(r["query_id"], r["vec_id"]) for r in got} & {(q, i) for q, _, i, _ in want}
    assert len(got) == len(want) and len(found) / len(want) >= 0.95
    by_id = dict(vectors)
    for r in got:
        assert abs(r["score"] - math.dist(by_id[r["query_id"]], by_id[r["vec_id"]])) < 1e-12


def test_neighbours_recall_over_many_shards(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = [(r["vec_id"], np.array(r["embedding"], float)) for r in df.collect()]
    index = hnsw.build_index(df, 11, 220)
    assert index.count() >= 8
    want = nearest(vectors, 10, 100)
    got = hnsw.search(df.filter("vec_id % 100 = 0"), index, 10).collect()
    found = {(r["query_id"], r["vec_id"]) for r in got} & {(q, i) for q, _, i, _ in want}
    assert len(got) == len(want) and len(found) / len(want) >= 0.95


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(900, None), (901, []), (902, [0.0, 0.0]), (903, [1.0, None]), (904, [nan, 1.0]), (905, [inf, 1.0]), (906, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    copies = [(i, [1.0, 1.0]) for i in range(100, 160)]
    others = [(i, [float(i), 1.0]) for i in range(2, 9)]
    df = spark.createDataFrame([*bad, *copies, *others, (0, [1.0, 1.0]), (0, [1.0, 1.0])], "vec_id long, embedding array<float>")
    index = hnsw.build_index(df, 11)
    rows = hnsw.search(df.filter("vec_id % 50 = 0 or vec_id > 899"), index, 10).collect()
    good = [(i, v) for i, v in [*copies, *others, (0, [1.0, 1.0])]]
    assert sorted(map(tuple, (r for r in rows if r["query_id"] < 900))) == sorted(nearest(good, 10, 50))
    assert not [r for r in rows if r["query_id"] >= 900]
    assert hnsw.search(df, hnsw.build_index(df.filter("false"), 11), 10).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs.persist()]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], SF).persist())
        if name != "bpe":
            assert seen[-1].columns == docs.columns
    start, clean, deduped, single, mixed, tokens = seen
    assert clean.count() < start.count()
    again = toxicity.score(start, toxicity.fit(start, spark.read.parquet(f"{SF}/labels.parquet")))
    assert {r[0] for r in clean.select("doc_id").collect()} == {r[0] for r in again.filter("score < 0.3").select("doc_id").collect()}
    lines_of = lambda df: [s for _, t in texts(df) for s in (t or "").split("\n") if s.strip()]
    assert len(lines_of(deduped)) == len(set(lines_of(deduped))) and set(lines_of(deduped)) <= set(lines_of(clean))
    assert {r[0] for r in single.select("doc_id").collect()} <= {r[0] for r in deduped.select("doc_id").collect()}
    sizes = mixing.word_count(F.col("text"))
    by_source = lambda df: {r[0]: r[1] for r in df.groupBy("source").agg(F.sum(sizes)).collect()}
    targets = {r["source"]: r["target"] for r in mixing.mix(single).join(single.select("doc_id", "source"), "doc_id").collect()}
    longest = single.agg(F.max(sizes)).first()[0]
    assert all(abs(n - targets[s]) <= longest for s, n in by_source(mixed).items())
    assert Counter(r[0] for r in tokens.select("doc_id").collect()) == Counter(r[0] for r in mixed.select("doc_id").collect())
    assert corpus_pipeline.run(spark, SF).count() == mixed.count()


def test_pipeline_of_odd_rows(spark, odd, tmp_path):
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name in ("documents", "empty"):
        rows = odd if name == "documents" else odd.filter("false")
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, str(tmp_path)).persist()
        assert (rows.count() > 0) == (name == "documents")
