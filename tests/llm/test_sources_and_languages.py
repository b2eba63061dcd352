"""Source divergence, language mixtures and importance resampling."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brokerdw.llm import divergence, languages, resampling
from brokerdw.llm.queries import ORACLES, QUERIES

from .conftest import SCHEMA, row

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_sql(name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    rel = con.sql(ORACLES[name])
    return rel.columns, rel.fetchall()


@pytest.mark.parametrize("name", ["op11_source_divergence", "op13_resampling"])
def test_equals_sql(spark, name):
    columns, want = by_sql(name)
    got = QUERIES[name](spark, SF).select(*columns).collect()
    assert Counter(map(tuple, got)) == Counter(want) and want


def audit_by_hand(rows, least, top):
    docs = [((r["lang"] or ""), (r["source"] or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (r["text"] or "").translate(LOWER))) for r in rows]
    df, n = defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in docs:
        df[lang].update(set(words))
        n[lang, source].update(words)
    out = []
    for lang in df:
        kept = [t for t, d in df[lang].items() if d >= least]
        groups = sorted({s for x, s, _ in docs if x == lang})
        whole = {s: sum(n[lang, s][t] for t in kept) for s in groups}
        p = lambda c, w: 1 + (10**9 * (c + 5)) // (w + 5 * len(kept))
        for s in groups:
            far = [(o, sum(abs(p(n[lang, s][t], whole[s]) - p(n[lang, o][t], whole[o])) for t in kept)) for o in groups if o != s]
            lang_n = {t: sum(n[lang, o][t] for o in groups) for t in kept}
            above = [(t, p(n[lang, s][t], whole[s]) - p(lang_n[t], sum(whole.values()))) for t in kept if n[lang, s][t]]
            above = [x for x in above if x[1] > 0]
            for part, found, most in (("pair", far, None), ("term", above, top)):
                found = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out.extend((lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found))
    return out


@pytest.mark.parametrize("least", [1, 3, 30])
def test_divergence_equals_brute_force(documents, odd, least):
    for df in (documents, odd):
        got = divergence.audit(df, least, 7).collect()
        assert Counter(map(tuple, got)) == Counter(audit_by_hand(df.collect(), least, 7))


def test_divergence_of_nothing(spark, empty):
    assert divergence.audit(empty).count() == 0
    bare = [(None, None, None), (None, "", "x"), ("1 2", "de", "y"), ("", "de", None)]
    got = divergence.audit(spark.createDataFrame(bare, "text string, lang string, source string")).collect()
    want = {("", "", "x"), ("", "x", ""), ("de", "y", ""), ("de", "", "y")}
    assert {(r["lang"], r["source"], r["item"]) for r in got} == want and all(r["value"] == 0 and r["rank"] == 1 for r in got)


def test_a_tree_cut_into_many_parts_gives_the_same(spark):
    rng = np.random.default_rng(5)
    rows = [("de", f"t{i}", s, int(rng.integers(1, 4)) * 10, s) for i in range(300) for s in range(1, 9) if rng.random() < 0.6]
    rows += [("de", f"u{i}", s, 20, s) for i in range(500) for s in (1, 4)]  # one path for many terms
    df = spark.createDataFrame(rows, "lang string, term string, place int, p long, zero long")
    want = Counter()
    terms = defaultdict(list)
    for _, t, s, p, z in rows:
        terms[t].append((s, p, z))
    for held in terms.values():
        for a, p, z in held:
            for b, q, y in held:
                if a < b:
                    want[a, b] += abs(p - q) - abs(p - y) - abs(z - q) + abs(z - y)
    got = {(r["a"], r["b"]): r["f"] for r in divergence.tree_corrections(df).collect()}
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def draw_by_hand(docs, target, run, buckets, percent, least):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        runs = [" ".join(words[i : i + k]) for k in range(1, run + 1) for i in range(len(words) - k + 1)]
        return words, [zlib.crc32(x.encode()) % buckets for x in runs]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    rows = []
    for doc_id, text in docs:
        words, found = features(text)
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words) >= least])
    fit = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(fit[: len(fit) * percent // 100]):
        r[4] = i + 1
    return [tuple(r[:5]) for r in rows]


@pytest.mark.parametrize("run", [1, 3])
def test_resampling_equals_brute_force(spark, documents, odd, run):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    target = [r["text"] for r in benchmark.collect()] + [None]
    wanted = benchmark.select("text").union(spark.createDataFrame([(None,)], "text string"))
    for df in (documents, odd):
        docs = [(r["doc_id"], r["text"]) for r in df.collect()]
        got = resampling.resample(df, wanted, run, 500, 40, 3).collect()
        assert Counter(map(tuple, got)) == Counter(draw_by_hand(docs, target, run, 500, 40, 3))


def test_resampling_of_copies_and_nothing(spark, empty):
    copies = [row(7, "one line of words\nanother line\none line of words")] * 9000 + [row(8, "one line of words")]
    df = spark.createDataFrame(copies, SCHEMA)
    got = resampling.resample(df, df.limit(0), least_words=1).collect()
    assert len(got) == 9001 and {(r["doc_id"], r["n_features"]) for r in got} == {(7, 10), (8, 4)}
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 901))
    assert resampling.resample(empty, df).count() == 0


def test_crossing_runs_are_those_that_lines_lack():
    text = b"a b\nc\n\nd e f"
    whole = Counter(resampling.line_buckets(resampling.words_of(text), 3, 10**6))
    parts = Counter(resampling.crossing_buckets(text, 3, 10**6))
    for line in text.split(b"\n"):
        parts.update(resampling.line_buckets(resampling.words_of(line), 3, 10**6))
    assert parts == whole


# -- languages --------------------------------------------------------------------------


def test_letter_models_equal_the_recursion():
    words = {"la": {"ab": 3, "abc": 1, "ü": 2}, "lb": {"ba": 4, "c": 1}}
    langs = sorted(words)
    counts = {x: Counter() for x in langs}
    for x in langs:
        for w, n in words[x].items():
            s = "\n\n" + w + "\n"
            for i in range(2, len(s)):
                counts[x][s[i - 2 : i + 1]] += n

    def chance(x, history, letter):
        n = Counter()
        for gram, c in counts[x].items():
            if gram[2 - len(history) : 2] == history:
                n[gram[2]] += c
        below = chance(x, history[1:], letter) if history else 1 / languages.LETTERS
        return (n[letter] + languages.BACKOFF * below) / (n.total() + languages.BACKOFF)

    grams, _ = languages.cut(sorted({w for x in langs for w in words[x]}))
    keys = np.unique(grams)
    table = np.zeros((len(keys), 2))
    for i, x in enumerate(langs):
        for gram, c in counts[x].items():
            key = (ord(gram[0]) << 42) | (ord(gram[1]) << 21) | ord(gram[2])
            table[np.searchsorted(keys, key), i] = c
    model = languages.Model.build(langs, keys, table)
    asked = ["ab", "ba", "ü", "abcba", "zz", "z"]
    want = []
    for w in asked:
        s = "\n\n" + w + "\n"
        want.append([sum(math.log(chance(x, s[i - 2 : i], s[i])) for i in range(2, len(s))) for x in langs])
    np.testing.assert_allclose(model.score(asked), want, rtol=1e-5)


def test_proportions_are_the_most_likely_ones():
    rng = np.random.default_rng(3)
    logs, times = np.log(rng.dirichlet(np.ones(40), 2).T), rng.integers(1, 5, 40).astype(float)
    share, reached = languages.proportions(logs, times)
    best = max((float(times @ np.log(np.exp(logs) @ [q, 1 - q])), q) for q in np.linspace(0.001, 0.999, 999))
    assert abs(share[0] - best[1]) < 0.02 and reached > best[0] - 0.01 and abs(share.sum() - 1) < 1e-9


def test_a_single_language_needs_no_second():
    logs = np.log(np.array([[0.2, 0.1, 0.1], [0.2, 0.21, 0.1]]))
    assert languages.mixture(logs, np.array([30.0, 10.0]))[0] == [0]


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES["op12_language_id"](spark, SF).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert len(got) == docs.count() and got["score"].between(0, 1).all()
    held = got[got["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.98
    assert (got["held_out"] == got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()


def test_two_languages_in_one_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = languages.fit(docs)
    some = {x: " ".join(r["text"] for r in docs.filter((F.col("lang") == x) & (F.length("text") > 2000)).limit(3).collect()) for x in ("en", "de", "fr")}
    mixed = [(1, some["en"][:1500] + " " + some["de"][:500]), (2, some["fr"][:900] + " " + some["de"][:900] + " " + some["en"][:900])]
    got = {r["doc_id"]: r for r in languages.identify(spark.createDataFrame(mixed, "doc_id long, text string"), model).collect()}
    assert got[1]["langs"] == ["en", "de"] and 0.6 < got[1]["shares"][0] < 0.9 and got[1]["lang_pred"] == "en"
    assert set(got[2]["langs"]) == {"en", "de", "fr"} and abs(sum(got[2]["shares"]) - 1) < 1e-6


def test_languages_of_odd_rows(spark, odd, empty):
    model = languages.fit(odd)
    got = {r["doc_id"]: r for r in languages.identify(odd, model).collect()}
    assert len(got) == odd.select("doc_id").distinct().count()
    assert got[4]["lang_pred"] == got[5]["lang_pred"] == got[6]["lang_pred"] == "und" and got[1]["lang_pred"] == "en"
    signs = spark.createDataFrame([(1, "² 12 _ ½ …"), (2, "語"), (3, "A² 1")], "doc_id long, text string")
    assert [r["lang_pred"] for r in languages.identify(signs, model).orderBy("doc_id").collect()] == ["und", "en", "en"]
    assert languages.identify(empty, model).count() == 0
    unlearned = languages.fit(empty)
    assert {(r["lang_pred"], r["score"]) for r in languages.identify(odd, unlearned).collect()} == {("und", 0.0)}


def test_the_words_remembered_do_not_change_a_result(documents, monkeypatch):
    model = languages.fit(documents)
    texts = [r["text"] for r in documents.collect()]
    want = list(languages.Identifier(model)(texts))
    monkeypatch.setattr(languages, "REMEMBERED", 50)
    monkeypatch.setattr(languages, "TOGETHER", 300)
    got = list(languages.Identifier(model)(texts))
    assert [g[0] for g in got] == [w[0] for w in want]
    pd.testing.assert_series_equal(pd.Series([g[2] for g in got]), pd.Series([w[2] for w in want]))
