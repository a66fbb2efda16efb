import random

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Columns of documents, and some whose names the operators use themselves.
EXTRA = ["key", "bits", "component_id", "nth", "score", "kept_key", "n"]
SCHEMA = StructType(
    [StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("source", StringType()), StructField("n_chars", LongType())]
    + [StructField(c, StringType()) for c in EXTRA]
)


def rows_of(texts, first=0):
    return [(first + i, t, "en" if i % 2 else "de", "s", None if t is None else len(t), *["x"] * len(EXTRA)) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, very long, repeated and mixed-script texts."""
    rnd = random.Random(5)
    words = ["the", "of", "haus", "straße", "naïve", "它", "don't", "we'll", "x=1;", "£5", "…", "12", " ", "👍🏽", "<|endoftext|>", "A" * 40]
    mixed = ["".join(rnd.choice(words) + rnd.choice([" ", "  ", "\n", "\t ", "", "'s "]) for _ in range(rnd.randint(1, 120))) for _ in range(60)]
    return [None, "", " ", "\n\n \t", "a", "a" * 3000, "é" * 1500, " " * 2000, "the quick " * 30_000, "=" * 700, "same text here", "same text here", *mixed]


@pytest.fixture(scope="session")
def odd(spark, odd_texts):
    rows = rows_of(odd_texts)
    return spark.createDataFrame([*rows, rows[10], (None, "no key", None, None, None, *["x"] * len(EXTRA))], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")
