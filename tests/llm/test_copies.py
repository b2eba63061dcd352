"""Near copies, line dedup and fingerprints against brute force."""

import hashlib
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from brokerdw.llm import fingerprints, lines, nearcopies
from brokerdw.llm.queries import QUERIES

from .conftest import PROSE, texts

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def classes(docs, size):
    sets = [(i, shingle_set(t, size)) for i, t in docs]
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(range(len(sets)), 2):
        x, y = sets[a][1], sets[b][1]
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            up[max(root(a), root(b))] = min(root(a), root(b))
    lows = {}
    for k, (i, _) in enumerate(sets):
        lows[root(k)] = min((j for j in (lows.get(root(k)), i) if j is not None), default=None)
    return sorted(((i, len(s), lows[root(k)]) for k, (i, s) in enumerate(sets)), key=repr)


@pytest.mark.parametrize("size", [4, 5])
def test_components_equal_brute_force(odd, documents, size):
    for df in (odd, documents):
        got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in nearcopies.cluster(df, size, 80).collect()]
        assert sorted(got, key=repr) == classes(texts(df), size)


def test_chains_and_large_groups(spark):
    """A chain of edits, 300 variants of one text, and texts that share half of it."""
    words = [f"w{i}" for i in range(120)]
    chain = [(i, " ".join(words[i * 4 : i * 4 + 80])) for i in range(10)]
    rng = np.random.default_rng(1)
    variants = []
    for i in range(300):
        w = [f"v{j}" for j in range(120)]
        for j in rng.choice(120, 1 + i % 4, replace=False):
            w[j] = f"x{i}_{j}"
        variants.append((100 + i, " ".join(w)))
    halves = [(1000 + i, " ".join([f"h{j}" for j in range(60)] + [f"y{i}_{j}" for j in range(40)])) for i in range(40)]
    docs = [*chain, *variants, *halves]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in nearcopies.cluster(df, 4, 80).collect()]
    assert sorted(got, key=repr) == classes(docs, 4)


def test_sketch_fills_every_bin_and_estimates():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 1 << 63, 900, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:600], rng.integers(0, 1 << 63, 300, dtype=np.uint64)]))
    x, y = (nearcopies.sketch(g, 2000) for g in (a, b))
    assert not (x == nearcopies.ALL).any() and abs((x == y).mean() - 0.5) < 0.06
    one = nearcopies.sketch(a[:1])
    assert not (one == nearcopies.ALL).any()


def test_one_of_each_keeps_columns_and_one_row(odd):
    kept = nearcopies.one_of_each(odd)
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == odd.columns and sorted(ids, key=repr) == sorted([1, 4, 5, 6, 7, 8, 9, 10, None, 12, -5, 1 << 40][0:1] + [4, 5, 6, 7, 8, 9, None, 12, -5, 1 << 40], key=repr)


def removed_by_hand(docs, percent=80):
    """Lines to remove per document (unique ids), comparing every line with all earlier ones."""
    seen, out = [], {}
    for i, t in docs:
        for at, line in enumerate(t.split("\n") if t is not None else []):
            s = frozenset(re.split(r"[ \t\r\x0b\f]+", line.lower())) - {""}
            if not s:
                continue
            if any(100 * len(s & e) >= percent * len(s | e) for e in seen):
                out.setdefault(i, []).append(at)
            seen.append(s)
    return out


def test_lines_equal_brute_force(spark, odd, documents):
    rng = np.random.default_rng(5)
    family = [(i, "\n".join(" ".join(w if rng.random() > 0.04 else f"e{rng.integers(99)}" for w in PROSE.split() * 1) for _ in range(6))) for i in range(40)]
    made = spark.createDataFrame(family, "doc_id long, text string")
    for df in (odd.dropDuplicates(["doc_id"]).filter("doc_id != 8"), documents, made):
        got = {r["doc_id"]: r["removed"] for r in lines.repeated_lines(df).collect()}
        assert got == removed_by_hand(texts(df))


@pytest.mark.parametrize("shares", [1, 3])
def test_lines_meet_in_shares_of_their_words(documents, monkeypatch, shares):
    names, keep = [], lines.stored
    monkeypatch.setattr(lines, "SHARES", shares)
    monkeypatch.setattr(lines, "stored", lambda df, name: names.append(name) or keep(df, name))
    got = {r["doc_id"]: r["removed"] for r in lines.repeated_lines(documents).collect()}
    assert got == removed_by_hand(texts(documents)) and names.count("lines-met") == shares


def test_loose_families_meet_few_pairs(spark, monkeypatch):
    """Lines that are like the tenth part of their family: no few leads stand for all, and no pair of members is formed for each."""
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(480):
        line = list(base)
        line[:7] = [f"k{i % 16}x{j}" for j in range(7)]
        line[7 + rng.integers(53)] = f"own{i}"
        rows.append((i, " ".join(line)))
    seen = {}
    keep = lines.stored

    def kept(df, name):
        seen[name] = keep(df, name)
        return seen[name]

    monkeypatch.setattr(lines, "stored", kept)
    got = {r["doc_id"]: r["removed"] for r in lines.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == removed_by_hand(rows) and len(got) == 464
    assert seen["lines-pairs"].count() < 1500  # of 6960 similar pairs


def test_text_without_repeats(spark):
    rows = [(1, "alpha beta gamma\ndelta epsilon", 9), (2, "Gamma alpha  beta\nzeta", 9), (3, "delta epsilon", 9), (4, "", 0), (5, None, None)]
    out = lines.without_repeats(spark.createDataFrame(rows, "doc_id long, text string, n_chars int"))
    assert sorted(map(tuple, out.collect())) == [(1, "alpha beta gamma\ndelta epsilon", 30), (2, "zeta", 4), (4, "", 0), (5, None, None)]
    assert out.schema["n_chars"].dataType.simpleString() == "int"


def test_lines_keep_columns_and_rows(odd):
    out = lines.without_repeats(odd)
    assert out.columns == odd.columns
    by_id = {r["doc_id"]: r["text"] for r in out.collect()}
    assert 2 not in by_id and 3 not in by_id and by_id[4] is None and by_id[9] == "A B" and 10 not in by_id
    assert out.filter("doc_id = 12").count() == 2


def fingerprint_set(text, size=fingerprints.WORDS):
    w = (text or "").lower().split()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def test_fingerprints(documents):
    docs = texts(documents)
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_edits(documents).collect()}
    assert len(got) == len(docs)
    for (i, t), (_, after) in zip(docs, docs[1:] + docs[:1]):
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        r = got[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, e, n = map(fingerprint_set, (t, edited, after))
        like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        tolerance = 1e-9 if len(a | e) <= fingerprints.K else 0.2
        assert abs(r["near_edited"] - like(a, e)) <= tolerance
        assert abs(r["near_next"] - like(a, n)) <= 0.2


def test_fingerprints_of_odd_rows(spark, odd, empty):
    rows = fingerprints.fingerprint_edits(odd).collect()
    assert len(rows) == odd.count() and fingerprints.fingerprint_edits(empty).count() == 0
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["sketch"] == by_id[2]["sketch"] and by_id[1]["near_next"] == 1.0
    assert by_id[4]["sketch"] == [] and by_id[4]["near_next"] == 1.0 and by_id[4]["n_chars"] == 0
    one = spark.createDataFrame([(7, "abcd")], "doc_id long, text string")
    assert fingerprints.fingerprint_edits(one).first()["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()


def test_sketches_merge(spark):
    parts = spark.createDataFrame([(g, " ".join(f"t{i}" for i in range(s, s + 400))) for g, s in ((1, 0), (1, 300), (2, 50))], "g long, text string")
    whole = spark.createDataFrame([(" ".join(f"t{i}" for i in range(400)),), (" ".join(f"t{i}" for i in range(300, 700)),)], "text string")
    sketched = fingerprints.with_sketch(parts, "text", "s")
    merged = {r["g"]: r["s"] for r in fingerprints.merge_sketches(sketched, ["g"], "s").collect()}
    a, b = [r["s"] for r in fingerprints.with_sketch(whole, "text", "s").collect()]
    assert merged[1] == sorted({*a, *b})[: fingerprints.K]
    pair = spark.createDataFrame([(merged[1], merged[2])], "a array<long>, b array<long>")
    r = pair.select(
        fingerprints.distinct_shingles(F.col("a")).alias("n"), fingerprints.containment(F.col("b"), F.col("a")).alias("c"),
        fingerprints.resemblance(F.col("a"), F.col("b")).alias("j"),
    ).first()
    assert abs(r["n"] - 696) < 200 and r["c"] > 0.8 and abs(r["j"] - 396 / 696) < 0.2


def test_native_operators_run_no_python(spark, documents):
    for df in (lines.repeated_lines(documents), fingerprints.fingerprint_edits(documents)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_empty_tables(empty):
    assert nearcopies.cluster(empty).count() == lines.repeated_lines(empty).count() == lines.without_repeats(empty).count() == 0


def test_query_columns(spark):
    got = QUERIES["op5_line_dedup"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_lines", "n_removed", "removed"] and got.count() == 200


@pytest.mark.parametrize("ids", ["hashed", "around 2**53", "one"])
def test_fingerprints_of_large_ids(spark, ids):
    texts_ = [f"{i} words of text number {i * i} and more" for i in range(200)]
    make = {
        "hashed": F.xxhash64("n"),
        "around 2**53": F.col("n") + F.lit((1 << 53) - 90),
        "one": F.lit((1 << 63) - 1),
    }[ids]
    rows = spark.createDataFrame(list(enumerate(texts_)), "n long, text string").select(make.cast("long").alias("doc_id"), "text")
    docs = sorted(((r["doc_id"], r["text"]) for r in rows.collect()), key=lambda r: r[0])
    got = fingerprints.fingerprint_edits(rows).collect()
    assert sorted(r["doc_id"] for r in got) == [i for i, _ in docs]
    if ids == "one":
        return
    by_id = {r["doc_id"]: r for r in got}
    for (i, t), (_, after) in zip(docs, docs[1:] + docs[:1]):
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        assert by_id[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()


def test_equal_lines_of_rows_without_an_id_or_with_one_id(spark):
    rows = [(None, "a b c d e\nx"), (None, "a b c d e\ny"), (None, "a b c d e\nz"), (7, "k l m n o\nu"), (7, "k l m n o\nv")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = lines.repeated_lines(df).collect()
    assert sorted((r["doc_id"] is None, r["removed"]) for r in got) == [(False, [0]), (True, [0]), (True, [0])]
    kept = lines.without_repeats(df).collect()
    assert sum("a b c d e" in r["text"] for r in kept) == 1 and sum("k l m n o" in r["text"] for r in kept) == 1
