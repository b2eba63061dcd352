"""BPE encoding and decoding with forced boundaries.

A pair of bytes that stands inside no token of the vocabulary can never be merged across:
every merge yields a token, and that token would hold the pair. Such pairs mark certain
cuts; the fragments between them are encoded on their own and concatenated. White space
stands in no token, so documents are cut there first; inside a word the pair table cuts
further. Only the last fragment of a word carries the word end mark.

Fragments are remembered in tables of bounded size. Nulls and empty texts have
no tokens; very long texts are read whole, word by word; repeated rows are encoded one by one;
an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer
from tokenizers.models import BPE

# Words, and runs without white space, remembered per Python worker (twice as many at most).
REMEMBERED = 150_000
# Letters whose words need no normalization beyond lower case: a-z and those of Latin-1.
PLAIN = [*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)]
ROWS_PER_BATCH = 512


class Memory(dict):
    """What ``make`` returns per key, for the keys met last: two generations of bounded size."""

    def __init__(self, make: Callable, size: int = REMEMBERED):
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Ids of a text, equal to the library's for the same vocabulary file."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        whole = Tokenizer.from_str(spec)
        self.normalize = whole.normalizer.normalize_str
        self.words = whole.pre_tokenizer.pre_tokenize_str
        self.mark = model["end_of_word_suffix"] or ""
        vocab = model["vocab"]
        merges = [tuple(m) for m in model["merges"]]
        self.ending = BPE(vocab, merges, end_of_word_suffix=model["end_of_word_suffix"])
        self.inner = BPE(vocab, merges)
        self.inside = {t[i : i + 2] for t in (v.removesuffix(self.mark) for v in vocab) for i in range(len(t) - 1)}
        self.special = {t["content"]: np.array([t["id"]], np.int32).tobytes() for t in data["added_tokens"]}
        names = sorted(self.special, key=len, reverse=True)
        self.special_at = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        probe = "".join(map(chr, PLAIN))
        letters = self.words(probe)
        # How the vocabulary writes the bytes of letters; letters that the normalizer changes are left out.
        self.letter = {c: w for c in probe for w, _ in self.words(c)} if len(letters) == 1 else {}
        self.letter = str.maketrans({c: w for c, w in self.letter.items() if self.normalize(c) == c})
        self.words_seen = Memory(self.word)
        self.chunks = Memory(self.run)

    def cut(self, word: str) -> list[str]:
        """Fragments of a word between byte pairs that are inside no token."""
        inside = self.inside
        cuts = [i + 1 for i, pair in enumerate(map(add, word, word[1:])) if pair not in inside]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True)]

    def word(self, word: str) -> bytes:
        """Ids of a word, fragment by fragment; only the last one carries the end mark."""
        *first, last = self.cut(word)
        ids = [t.id for part in first for t in self.inner.tokenize(part)]
        ids += [t.id for t in self.ending.tokenize(last)]
        return array("i", ids).tobytes()

    def run(self, chunk: bytes) -> bytes:
        """Ids of a run without white space, as 32-bit integers."""
        text = chunk.decode("utf-8")
        core = text.rstrip(".,")
        plain = core.lower()
        if core.isalpha() and all(ord(c) in self.letter for c in set(plain)):
            ids = self.words_seen[plain.translate(self.letter)]
            return ids + self.words_seen[text[len(core) :]] if len(core) < len(text) else ids
        return b"".join([self.words_seen[w] for w, _ in self.words(self.normalize(text))])

    def plain(self, text: str) -> bytes:
        return b"".join(map(self.chunks.__getitem__, text.encode("utf-8").split()))

    def encode(self, text: str) -> bytes:
        if self.special_at is None or not self.special_at.search(text):
            return self.plain(text)
        parts = self.special_at.split(text)
        return b"".join(self.special[p] if p in self.special else self.plain(p) for p in parts)


@lru_cache(maxsize=2)
def encoder(spec: str) -> Encoder:
    """Kept by a Python worker from task to task, so that fragments are encoded once."""
    return Encoder(spec)


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Per row: doc_id, ids (array of int). ``path``: a tokenizer file the driver can read."""
    with open(path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file: a fixed size

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(spec.value)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_BATCH):
                part = batch.slice(start, ROWS_PER_BATCH)
                packed = [own.encode(t or "") for t in part.column(1).to_pylist()]
                ends = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text).mapInArrow(task, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Add ``decoded``: the library's text for ``ids``, special tokens kept.

    The vocabulary file names no decoder; the library then joins the tokens by blanks.
    """
    with open(path, encoding="utf-8") as f:
        spec = encoded.sparkSession.sparkContext.broadcast(f.read())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = json.loads(spec.value)
        if data["decoder"] is not None:
            raise ValueError("this tokenizer names a decoder")
        names = {i: t for t, i in data["model"]["vocab"].items()} | {t["id"]: t["content"] for t in data["added_tokens"]}
        name = np.array([names.get(i, "") for i in range(max(names) + 1)], object)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_BATCH):
                part = batch.slice(start, ROWS_PER_BATCH)
                ids = part.column(1)
                tokens, ends = name[ids.flatten().to_numpy()].tolist(), np.cumsum([0, *(n or 0 for n in ids.value_lengths().to_pylist())])
                texts = [" ".join(tokens[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), ids, pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"]
                )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(task, f"doc_id {kind}, ids array<int>, decoded string")
