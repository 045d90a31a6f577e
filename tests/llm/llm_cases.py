"""Fixtures and helpers of the tests in this folder."""
import pytest
from pyspark.sql import functions as F

SF0001, SF001 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
BLANK = "[\x20\x09-\x0d]"

#: Names that operators use inside; as extra columns they must not clash.
CLASHES = ("row", "batch", "bucket", "digest", "segment", "id", "shard", "length", "lines", "key", "score",
           "label", "start", "suffix", "first", "n", "range", "pos", "payload")


def clashing(df):
    """The table with extra columns of those names."""
    for name in CLASHES:
        if name not in df.columns:
            df = df.withColumn(name, F.lit("x"))
    return df


@pytest.fixture(scope="session")
def table(spark):
    def make(rows, schema, extra=True):
        df = spark.createDataFrame(rows, schema)
        return clashing(df) if extra else df
    return make


LONG = " ".join(f"word{i % 977} piece{i % 31}," for i in range(12_000))

#: Null and empty texts, blanks, ties, repeated rows, null ids, one very long text.
EDGE_DOCS = [
    (1, "The quick brown fox jumps over the lazy dog again and again\nshared line of more than twenty characters"),
    (2, "The quick brown fox  jumps over the lazy dog again and again\nshared line of more than twenty characters "),
    (2, "The quick brown fox  jumps over the lazy dog again and again\nshared line of more than twenty characters "),
    (3, None), (4, ""), (5, " \t\n"), (None, "a text without an id\nshared line of more than twenty characters"),
    (None, None), (6, LONG), (7, "Shared line of more than twenty characters\n\nshort\n"),
    (8, "Été où ÇA é́ İx ΣΑΣ 12.5 <|endoftext|> don't !!"), (9, "one"),
]


def same(got, expected):
    """Equal as multisets of rows."""
    assert sorted(got, key=repr) == sorted(expected, key=repr)
