import pytest
from pyspark.sql import types as T

from .data import SCHEMA


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, ties, and
    columns whose names clash with the operators' own."""
    long = " ".join(f"word{i % 977} filler{i}" for i in range(40_000))
    rows = [
        (1, None, None, None, None, "a", 1),
        (2, "", "en", "s", 0, "a", 1),
        (3, " \n\t ", "en", "s", 4, None, None),
        (4, "1234 5678 -- !!", "en", None, 15, "a", 1),
        (5, long, "en", "s", len(long), "a", 1),
        (6, "same text " * 30, "en", "s", 300, "a", 1),
        (7, "same text " * 30, "fr", "s", 300, "a", 1),
        (7, "same text " * 30, "fr", "s", 300, "a", 1),
        (8, "emoji 😀 ñandú straße ÀÉ\x85\xa0x", "es", "s", 20, "a", 1),
        (None, "no id here but some words", None, "s", 25, "a", 1),
        (None, None, "de", "s", None, "a", 1),
    ]
    return spark.createDataFrame(rows, T.StructType.fromDDL(SCHEMA))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], T.StructType.fromDDL(SCHEMA))


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
