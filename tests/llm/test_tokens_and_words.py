"""Licence scan, language model and BPE against brute force."""

import functools
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
from tokenizers import Tokenizer

from brokerdw.llm import bpe, katz, license
from brokerdw.llm.queries import QUERIES

from .conftest import texts

PATH = public_tokenizers.path("word_bpe_49k.json")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def licence_places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII))
    found = [(i, label) for p, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    return len(words), sorted(found)


def test_licence_places_equal_brute_force(odd, documents):
    for df in (odd, documents):
        got = {(r["doc_id"], r["n_words"], tuple(sorted((s["start"], s["label"]) for s in r["spans"] if s["base"])))
               for r in license.scan(df).collect()}
        assert got == {(i, n, tuple(p)) for i, t in texts(df) for n, p in [licence_places(t)]}


def test_licence_notices_need_their_key_phrases(spark):
    whole = "Copyright. Permission is hereby granted, free of charge, to any person obtaining a copy of this software!"
    rows = [(1, whole), (2, whole.replace("free of charge", "for a fee")), (3, "GNU General Public License, version 3"), (4, "cc-by-nc")]
    found = {r["doc_id"]: {s["label"] for s in r["spans"]} for r in license.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: {"mit"}, 2: set(), 3: {"gpl-3"}, 4: {"cc-by-nc"}}


def licence_labels(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: sorted({s["label"] for s in r["spans"]}) for r in license.scan(rows).collect()}
    return [found[i] for i in range(len(texts))]


def test_licence_headers_as_they_are_written(spark):
    gnu = ("This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU {}General Public License as\n"
           "# published by the Free Software Foundation, either version {} of the License, or\n# (at your option) any later version.")  # fmt: skip
    headers = {
        gnu.format("", 3): ["gpl-3"],
        gnu.format("", 2): ["gpl-2"],
        gnu.format("Affero ", 3): ["agpl-3"],
        gnu.format("Lesser ", "2.1"): ["lgpl"],
        gnu.format("Library ", 2): ["lgpl"],
        "under the terms of version 2 of the GNU General Public License": ["gpl-2"],
        "GNU General Public License as published by the Free Software Foundation, version 4": [],
        "subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed": ["mpl-2"],
        "subject to the Mozilla Public License, v. 1.1": [],
        'Licensed under the Apache License 2.0 (the "License"); you may not use this file except in compliance with the License.': ["apache-2"],
        "Creative Commons Attribution 4.0 International Public License": ["cc-by"],
        "Creative Commons Attribution-NonCommercial 4.0 International Public License": [],
    }
    assert licence_labels(spark, headers) == list(headers.values())


def test_licence_notices_stand_left_out_and_added_words(spark):
    isc = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee"
    texts = [
        isc.replace("/or", ""),  # the common text
        isc.replace("this software", "this software and all of its documentation"),
        isc.replace("or without fee", "a fee"),  # no key phrase
        "Permission to use, copy, modify. " + "word " * 9 + "with or without fee",
        "with or without fee this software, distribute: permission to use, copy, modify",  # another order
        f"{isc.replace('/or', '')}\n{isc}",
    ]
    assert licence_labels(spark, texts) == [["isc"], ["isc"], [], [], [], ["isc"]]
    index = license.Index(license.TEMPLATES, {}, 1)
    assert [p[1] for p in index.places(license.words_of(texts[-1]))] == [0, 16]


def test_licence_query_columns(spark):
    rows = QUERIES["op1_license_scan"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all((r["n_base"] == 0) == (r["first_word"] is None) and 0 <= r["score"] <= 1 for r in rows)


def katz_by_hand(docs):
    """The model in plain Python: score per document, and the probability of a word after a context."""
    split = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(ASCII)), "\n"]
    train = [t for i, t in docs if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    one, two, after = Counter(), Counter(), Counter()
    for t in train:
        w = split(t)
        one.update(w)
        two.update(zip([" ", *w], w))
        after.update([" ", *w[:-1]])
    d1, d2 = (katz.discounts([sum(c == r for c in x.values()) for r in range(1, katz.CUT + 2)]) for x in (one, two))
    n = sum(one.values())
    lower = {w: d1[min(c, katz.CUT + 1)] * c / (n + 1) for w, c in one.items()}
    unknown = 1 - sum(lower.values())
    seen = lambda h, w: d2[min(two[h, w], katz.CUT + 1)] * two[h, w] / (after[h] + 1)

    def alpha(h):
        follow = [w for g, w in two if g == h]
        return (1 - sum(seen(h, w) for w in follow)) / (1 - sum(lower[w] for w in follow))

    def p(h, w):
        low = lower.get(w, unknown)
        return low if not after[h] else seen(h, w) if two[h, w] else alpha(h) * low

    scores = []
    for i, t in docs:
        w = split(t)
        base = sum(math.log10((one[x] + 1) / (n + len(one) + 1)) for x in w)
        scores.append((i, len(w), sum(one[x] > 0 for x in w), n, round(base, 6), round(sum(math.log10(p(h, x)) for h, x in zip([" ", *w], w)), 6)))
    return scores, p, lower, unknown


def test_language_model_equals_recursion_by_hand(spark, odd):
    some = spark.createDataFrame(
        [(i, f"the cat {'sat' if i % 3 else 'ran'} on the {'mat' if i % 2 else 'red roof'} {i % 11}") for i in range(60)],
        "doc_id long, text string",
    )
    for df in (some, odd.filter("doc_id is null or doc_id != 8")):
        want, p, lower, unknown = katz_by_hand(texts(df))
        got = [(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in katz.score(df).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
        for context in (" ", "the", "never met"):
            assert abs(sum(p(context, w) for w in lower) + p(context, "never met") - 1) < 1e-9


def katz_of_order(docs, order):
    """The recursion in plain Python for any order."""
    split = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(ASCII)), "\n"]
    grams = lambda w, k: list(zip(*[([" "] * (k - 1) + w)[i:] for i in range(k)]))
    counts = [Counter(g for i, t in docs if i is None or zlib.crc32(str(i).encode()) % 7 != 2 for g in grams(split(t), k)) for k in range(1, order + 1)]
    d = [katz.discounts([sum(c == r for c in x.values()) for r in range(1, katz.CUT + 2)]) for x in counts]
    after, follow = Counter(), {}
    for x in counts:
        for g, c in x.items():
            after[g[:-1]] += c
            follow.setdefault(g[:-1], []).append(g[-1])
    seen = lambda g: d[len(g) - 1][min(counts[len(g) - 1][g], katz.CUT + 1)] * counts[len(g) - 1][g] / (after[g[:-1]] + 1)
    unknown = 1 - sum(seen(g) for g in counts[0])

    @functools.cache
    def alpha(h):
        return (1 - sum(seen((*h, w)) for w in follow[h])) / (1 - sum(p((*h[1:], w)) for w in follow[h]))

    def p(g):
        if counts[len(g) - 1][g]:
            return seen(g)
        if len(g) == 1:
            return unknown
        return p(g[1:]) * (alpha(g[:-1]) if after[g[:-1]] else 1)

    return [(i, round(sum(math.log10(p(g)) for g in grams(split(t), order)), 6)) for i, t in docs], p, [g[0] for g in counts[0]]


def test_language_model_of_higher_orders_equals_recursion(spark, odd, monkeypatch):
    some = spark.createDataFrame(
        [(i, f"the cat {'sat' if i % 3 else 'ran'} on the {'mat' if i % 2 else 'red roof'} {i % 11}") for i in range(60)],
        "doc_id long, text string",
    )
    monkeypatch.setattr(katz, "PART_TOKENS", 100)
    for df, order in ((some, 3), (some, 4), (odd.filter("doc_id is null or doc_id != 8"), 3)):
        want, p, words = katz_of_order(texts(df), order)
        got = [(r["doc_id"], round(r["score"], 6)) for r in katz.score(df, order).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
        for context in ((" ", " "), (" ", "the"), ("on", "the"), ("never", "met"), ("met", "the")):
            assert abs(sum(p((*context, w)) for w in words) + p((*context, "never met")) - 1) < 1e-9


def test_language_model_query_scores_trigrams(spark):
    want, _, _ = katz_of_order(texts(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")), 3)
    got = {r["doc_id"]: r["score"] for r in QUERIES["op2_katz"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(want) and all(abs(got[i] - s) < 1e-5 for i, s in want)


def test_language_model_chunks_do_not_matter(odd, monkeypatch):
    rows = lambda: sorted(((r["doc_id"], r["n_known"], round(r["score"], 6)) for r in katz.score(odd).collect()), key=repr)
    whole = rows()
    monkeypatch.setattr(katz, "PART_TOKENS", 3_000)
    assert rows() == whole


def test_language_model_sends_only_sums_that_held_out_texts_may_ask_for(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2]
    train = [i for i in range(200) if i not in held]

    def sent(held_text):
        rows = [(i, f"red fish swim in lake {i}") for i in train] + ([(held[0], held_text)] if held_text else [])
        table = katz.chunks(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).cache()
        answers, stats = [], {}
        for k in (1, 2, 3):
            counted = katz.asks(table, k, 1).groupBy("ord", "part").applyInPandas(katz.count_part, katz.COUNTS).collect()
            answers.append(katz.unpack(next(r["counts"] for r in counted if r["kind"] == "answer"), np.uint64))
            stats[k] = next(r["stats"] for r in counted if r["kind"] == "count")
        row = table.first()
        c = katz.Chunk(row["lengths"], row["train"], row["words"], row["tokens"])
        _, sums, wanted = katz.score_chunk(c, answers, katz.Model(stats, len(train), 3), 1)
        keys = lambda found: {k: set(katz.unpack_sorted(b, np.uint64).tolist()) for k, _, b, *_ in found}
        for _, _, names, a, b in sums:
            assert len(katz.unpack_sorted(names, np.uint64)) == len(katz.unpack_floats(a)) == len(katz.unpack_floats(b))
        return keys(sums), keys(wanted)

    sums, wanted = sent(None)
    assert {k: len(v) for k, v in sums.items()} == {2: 1, 3: 1} and not wanted  # the empty context alone
    sums, wanted = sent("red fish fly")
    assert {k: len(v) for k, v in sums.items()} == {2: 3, 3: 3}  # and: red, fish; a first red, red fish
    assert all(wanted[k] <= sums[k] for k in wanted) and len(wanted[2]) == len(wanted[3]) == 1


def test_language_model_weights_come_as_one_row_a_chunk():
    keys, one = katz.pack_sorted(np.array([5], np.uint64)), katz.pack_floats(np.array([0.5]))
    asked = katz.pack_sorted(np.array([5] * 30, np.uint64)), katz.pack(np.arange(30, dtype=np.uint32))
    pdf = pd.DataFrame([(2, 0, 7, keys, one, one), (2, 0, 7, *asked, None)], columns=["ord", "part", "chunk", "keys", "a", "b"])
    found = katz.weigh_part(pdf)
    assert len(found) == 1 and len(katz.add_up(pd.concat([found, found]))) == 30


def test_language_model_numbers_survive_packing():
    a = np.array([0.25, 1e-300, 0.25, 1 / 3, 0.25])
    assert katz.unpack_floats(katz.pack_floats(a)).tolist() == a.tolist()
    h = np.array([9, 2**64 - 1, 3, 4], np.uint64)
    assert katz.unpack_sorted(katz.pack_sorted(h), np.uint64).tolist() == h.tolist()


def test_language_model_keeps_wide_ids(spark):
    ids = [(1 << 60) + 1, (1 << 60) + 2, None, -(1 << 61) - 3]
    rows = spark.createDataFrame([(i, "the cat sat") for i in ids], "doc_id long, text string").coalesce(1)
    assert sorted((r["doc_id"] for r in katz.score(rows).collect()), key=repr) == sorted(ids, key=repr)


def test_tokens_equal_the_library(odd, documents):
    tokenizer = Tokenizer.from_file(PATH)
    for df in (odd, documents):
        got = {(r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in bpe.decode(bpe.encode(df, PATH), PATH).collect()}
        want = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in texts(df)]
        assert got == {(i, tuple(ids), tokenizer.decode(ids, skip_special_tokens=False)) for i, ids in want}


def test_token_query_digests(spark):
    tokenizer = Tokenizer.from_file(PATH)
    want = set()
    for i, t in texts(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")):
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.add((i, len(ids), digest(" ".join(map(str, ids))), digest(tokenizer.decode(ids, skip_special_tokens=False))))
    assert {tuple(r) for r in QUERIES["op3_bpe"](spark, "/root/testdata/sf0.001").collect()} == want


def test_forced_boundaries_cut_only_where_no_token_reaches():
    encoder = bpe.Encoder(open(PATH, encoding="utf-8").read())
    for word in ("straße", "xqzjvk", "thqthq", "zzzzzzzz"):
        chars = encoder.words(encoder.normalize(word))[0][0]
        cuts = encoder.cut(chars)
        assert "".join(cuts) == chars and all(a[-1] + b[0] not in encoder.inside for a, b in zip(cuts, cuts[1:]))


def test_empty_tables(empty):
    assert license.scan(empty).count() == katz.score(empty).count() == bpe.decode(bpe.encode(empty, PATH), PATH).count() == 0
