import pytest
from pyspark.sql import types as T

from tidegauge.llm.common import ship

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use for columns of their own.
        *[T.StructField(n, T.StringType()) for n in ("doc", "line", "part", "queue", "n", "kept", "score", "words")],
    ]
)


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, len(text or ""), *["x"] * 8)


PROSE = "the quick brown fox jumps over the lazy dog while seven wizards mix a potion of old honey"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def make(spark):
    def table(rows):
        return spark.createDataFrame(rows, SCHEMA)

    return table


@pytest.fixture(scope="session")
def awkward(make):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing names."""
    words = " ".join(f"{w}{k}" for k in range(4000) for w in PROSE.split())
    return make(
        [
            row(1, PROSE),
            row(1, PROSE),
            row(2, PROSE),
            row(3, None),
            row(4, ""),
            row(5, " \t\n\n  "),
            row(6, words),
            row(7, "x" * 300_000),
            row(8, "one\n" * 3000),
            row(9, PROSE + "\n" + PROSE, None, None),
            row(None, PROSE + " again"),
            row(None, None, None, None),
            (10, "a b", None, None, None, *[None] * 8),
            row(11, "joe@example.com 4111 1111 1111 1111 +1 (555) 123-4567 and 10.0.0.1 \x00 \x1c  <|endoftext|> ﬁ"),
        ]
    )


@pytest.fixture(scope="session")
def empty(make):
    return make([])
