"""Small tables with everything odd in them."""

import pytest
from pyspark.sql import types as T

from brokerdw.llm.common import ship_package

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use for themselves
        *[T.StructField(n, T.StringType()) for n in ("_row", "_id", "_g", "node", "score", "key", "removed", "n", "size", "_tie")],
    ]
)
PROSE = "The quick brown fox jumps over the lazy dog near the old river bank while seven grey geese fly south again"


def row(doc_id, text, source="a"):
    return (doc_id, text, "en", source, None if text is None else len(text), *["x"] * 10)


def odd_rows():
    words = PROSE.split()
    long = " ".join(words[i % 19] + str(i % 977) for i in range(30_000))
    rows = [
        row(1, PROSE),
        row(2, PROSE),  # a copy
        row(3, PROSE + " today"),  # a near copy
        row(4, None),
        row(5, ""),
        row(6, " \t\n "),
        row(7, "One \U0001f600 Ünï\r\nline two\n\nOne \U0001f600 ünï\r", None),
        row(8, long, None),
        row(9, "A B", ""),
        row(10, "a b", "b"),
        row(None, "text without an id and more words than five", "b"),
        row(12, "x", None),
        row(12, "x", None),  # a repeated row
        row(-5, "Released under the MIT License. Apache License, Version 2.0; under the mit license"),
        row(1 << 40, "stupid <|endoftext|> text", "c"),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    ship_package(spark)
    return spark.createDataFrame(odd_rows(), SCHEMA).persist()


@pytest.fixture(scope="session")
def empty(spark):
    ship_package(spark)
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    ship_package(spark)
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").persist()


def texts(df):
    """(doc_id, text) in order."""
    return sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=lambda r: (r[0] is None, r[0]))
