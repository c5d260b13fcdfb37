from __future__ import annotations

import random

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

WORDS = "alpha beta gamma delta river stone cloud grass light house table green seven paper music ocean".split()
DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])


@pytest.fixture
def docs(spark):
    """A documents table of (doc_id, text) rows, in two partitions."""

    def make(*rows):
        return spark.createDataFrame(list(rows), DOCS).repartition(2)

    return make


@pytest.fixture
def odd(docs):
    """Rows every operator must stand: nulls, empty and blank texts, repeats, a very long text."""
    return docs(
        (1, None), (2, ""), (3, " \n\t "), (4, "alpha"), (4, "alpha"), (5, "alpha beta"), (None, "alpha beta gamma delta"),
        (6, "x" * 200_000), (7, "alpha beta gamma " * 20_000), (8, "ß é ñ 一二三 🙂 ­"),
    )


@pytest.fixture
def prose():
    """Words without meaning, the same for the same seed."""

    def make(n, seed):
        draw = random.Random(seed)
        return " ".join(draw.choice(WORDS) + draw.choice(WORDS) + draw.choice(WORDS) for _ in range(n))

    return make
