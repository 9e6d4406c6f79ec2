import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=4000):
    return " ".join(f"w{int(rng.paretovariate(1.1)) % vocabulary}x{rng.randrange(30)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, columns with clashing names."""
    rng = random.Random(3)
    long = "\n".join(words(rng, 12) + "." for _ in range(900))
    rows = [
        (1, "The quick brown fox. Released under the MIT License.\nNext line", "en", "a", 1),
        (2, None, "en", "a", None),
        (3, "", None, None, 0),
        (4, " \t\n ", "en", "b", 4),
        (5, long, "en", "b", len(long)),
        (6, "é 😀 naïve ÇA\nva", "fr", None, 5),
        (7, "same text here again and again", "en", "c", 9),
        (8, "same text here again and again", "en", "c", 9),
        (8, "same text here again and again", "en", "c", 9),
        (9, "one", "en", "b", 3),
        (None, "a row without id", "en", "a", 7),
        (10, "x" * 3000, "en", "a", 3000),
        (9, "another text with the id of one", "en", "b", 3),
    ]
    df = spark.createDataFrame([(*r, 5, "size", 0.5) for r in rows], SCHEMA + ", size int, rid string, score double")
    return df.cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").cache()


@pytest.fixture(scope="session")
def labels(spark, sf):
    return spark.read.parquet(f"{sf}/labels.parquet").cache()
