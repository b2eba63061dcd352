"""Licence scan by a positional index of rare words.

Every template is a sequence of words: a phrase that must stand word for word, or a notice
with mandatory key phrases. The index holds, for each phrase, its words with the highest
inverse document frequency over all documents, with their positions, and for each notice
the rarest word of each key phrase. In a file, occurrences of a phrase's rarest word give
candidate starts; the postings of its other indexed words at the same relative position
confirm or drop them. For a notice the postings of the indexed words lead to the key
phrases; where all of them stand within ``SHIFT`` words of their places around one start,
the share is counted in order over the starts within ``SHIFT`` of it, so that words left out
or put in do not end the match. Of the places of a notice within ``SHIFT`` words the fullest
counts.

Words are runs of 0-9, a-z and characters beyond ASCII, after lower-casing A-Z.

Nulls and empty texts have no words, no labels and score 0; long texts are read whole;
repeated rows are scanned one by one; an empty table gives no rows; extra columns are not
read.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rare words per phrase that the index holds.
INDEXED = 4
# Share of a notice's words that a place must hold, and words by which a word or key phrase may be shifted.
COVERAGE, SHIFT = 0.7, 6
# Byte table: A-Z become a-z, ASCII other than letters and digits becomes a blank.
TABLE = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).lower()


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...] = ()  # mandatory phrases; none: the whole text
    base: bool = False


# The base phrases of the query, then notices and their key phrases.
TEMPLATES = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
    Template("gpl-3", "gnu general public license version 3"),
    Template("gpl-2", "gnu general public license version 2"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl-3", "gnu affero general public license version 3"),
    Template("mpl-2", "mozilla public license version 2"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             ("source and binary forms", "with or without modification")),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             ("permission is hereby granted", "free of charge")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee",
             ("permission to use copy modify", "with or without fee")),
    Template("cc-by", "creative commons attribution 4 0 international license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("free and unencumbered software", "public domain")),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
             ("apache license", "2 0", "in compliance with the license")),
    Template("gpl-3", "gnu general public license as published by the free software foundation either version 3",
             ("gnu general public license", "free software foundation", "version 3")),
    Template("gpl-2", "gnu general public license as published by the free software foundation either version 2",
             ("gnu general public license", "free software foundation", "version 2")),
    Template("gpl-3", "version 3 of the gnu general public license", ("version 3", "gnu general public license")),
    Template("gpl-2", "version 2 of the gnu general public license", ("version 2", "gnu general public license")),
    Template("lgpl", "gnu lesser general public license as published by the free software foundation",
             ("lesser general public license", "free software foundation")),
    Template("lgpl", "gnu library general public license as published by the free software foundation",
             ("library general public license", "free software foundation")),
    Template("agpl-3", "gnu affero general public license as published by the free software foundation either version 3",
             ("affero general public license", "free software foundation", "version 3")),
    Template("mpl-2", "mozilla public license v 2 0", ("mozilla public license", "2 0")),
    Template("cc-by", "creative commons attribution 4 0 international public license", ("creative commons attribution 4 0",)),
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(TABLE).split()


def template_words(templates: Sequence[Template]) -> set[bytes]:
    return {w for t in templates for w in words_of(t.text)}


def document_frequencies(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, text: str = "text") -> DataFrame:
    """word, n: documents holding each template word; counted per task first, over all documents."""
    wanted = template_words(templates)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for value in batch.column(0):
                found.update(wanted.intersection(words_of(value.as_py())))
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in found], pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"]
        )

    return docs.select(text).mapInArrow(task, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Index:
    """Postings of the rarest words of each template."""

    def __init__(self, templates: Sequence[Template], frequency: dict[str, int], documents: int):
        idf = {w: math.log((1 + documents) / (1 + frequency.get(w.decode(), 0))) for w in template_words(templates)}
        self.plans = []
        for t in templates:
            words = words_of(t.text)
            rarest = lambda positions: sorted(positions, key=lambda i: (-idf[words[i]], i))  # noqa: B023, E731
            keys = []
            for phrase in t.keys:
                k = words_of(phrase)
                at = next(i for i in range(len(words)) if words[i : i + len(k)] == k)
                keys.append((k, at, rarest(range(at, at + len(k)))[0]))
            chosen = [i for _, _, i in keys] or rarest(range(len(words)))[:INDEXED]
            self.plans.append((t, words, [(words[i], i) for i in chosen], keys))
        self.vocabulary = {w for _, _, chosen, _ in self.plans for w, _ in chosen}

    def places(self, words: list[bytes]) -> list[tuple[str, int, int, float, bool]]:
        """(label, start, words, share of the template found, base) of every place."""
        at: dict[bytes, list[int]] = {}
        for w in self.vocabulary.intersection(words):
            at[w] = []
        if not at:
            return []
        for i, w in enumerate(words):
            if w in at:
                at[w].append(i)
        found = []
        for t, text, chosen, keys in self.plans:
            if any(w not in at for w, _ in chosen):
                continue
            if keys:
                found.extend((t.label, max(start, 0), len(text), share, t.base) for start, share in notices(words, text, keys, at))
                continue
            starts = {p - chosen[0][1] for p in at[chosen[0][0]]}
            for w, i in chosen[1:]:
                starts.intersection_update([p - i for p in at[w]])
            for start in sorted(starts):
                if start >= 0 and words[start : start + len(text)] == text:
                    found.append((t.label, start, len(text), 1.0, t.base))
        return found


def notices(words: list[bytes], text: list[bytes], keys: list, at: dict[bytes, list[int]]) -> list[tuple[int, float]]:
    """(start, share) of the places of a notice."""
    starts = []  # of the notice, as each key phrase has it
    for k, place, rare in keys:
        begins = [p - (rare - place) for p in at[text[rare]]]
        starts.append([b - place for b in begins if b >= 0 and words[b : b + len(k)] == k])
    found: list[tuple[int, float]] = []
    for low in sorted(set().union(*starts)):
        nearest = [x[i] if (i := bisect_left(x, low)) < len(x) else None for x in starts]
        if None in nearest:
            break
        if max(nearest) - low > 2 * SHIFT:
            continue
        start = (low + max(nearest)) // 2
        share = shared(words, text, start)
        if share < COVERAGE:
            continue
        if found and start - found[-1][0] <= SHIFT:
            if share > found[-1][1]:
                found[-1] = (start, share)
        else:
            found.append((start, share))
    return found


def shared(words: list[bytes], text: list[bytes], start: int) -> float:
    """Share of the words of ``text`` that stand in its order within ``SHIFT`` words of their places."""
    best = [0] * (2 * SHIFT + 1)  # most words found so far, by shift
    for i, w in enumerate(text):
        first = start + i - SHIFT
        before, best = [*best, 0], []
        for s in range(2 * SHIFT + 1):
            n = before[s] + (0 <= first + s < len(words) and words[first + s] == w)
            best.append(max(n, before[s + 1], best[-1] if best else 0))
    return max(best) / len(text)


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, text: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, spans (label, start, words, share, base) in order of templates and starts."""
    counted = document_frequencies(docs, templates, text).collect()  # a row for each template word
    frequency = {r["word"]: r["n"] for r in counted}
    index = Index(templates, frequency, max(frequency.values(), default=0))
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.struct(
        [("label", pa.string()), ("start", pa.int64()), ("words", pa.int64()), ("share", pa.float64()), ("base", pa.bool_())]
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, spans = [], []
            for value in batch.column(1):
                words = words_of(value.as_py())
                counts.append(len(words))
                spans.append([dict(zip(("label", "start", "words", "share", "base"), p, strict=True)) for p in index.places(words)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(spans, pa.list_(span))], ["doc_id", "n_words", "spans"]
            )

    schema = (
        f"doc_id {kind}, n_words long, spans array<struct<label: string, start: long, words: long, share: double, base: boolean>>"
    )
    return docs.select("doc_id", text).mapInArrow(task, schema)
