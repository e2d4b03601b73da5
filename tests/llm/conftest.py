import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return [rng.choice("bcdfghklmnprstvw") + rng.choice("aeiou") + rng.choice("bcdfghklmnprst") + rng.choice(["", "ing", "er", "o", "an"]) for _ in range(n)]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, repeated rows, columns with clashing names."""
    rng = random.Random(5)
    long_text = " ".join(words(rng, 20_000))
    plain = " ".join(words(rng, 60))
    rows = [
        (1, plain, "en", "a", len(plain)), (2, plain, "en", "a", len(plain)), (2, plain, "en", "a", len(plain)), (3, None, "en", "b", None), (4, "", None, None, 0),
        (5, " \n\t ", "de", "a", 4), (None, plain, "en", "a", 1), (None, None, None, None, None), (6, "one", "en", "b", 3), (7, long_text, "en", "a", len(long_text)),
        (8, "x" * 50_000, "fr", "b", 50_000), (9, "a " * 500, "es", None, 1000), (10, "ümläut   ñ 漢字 " * 9, "xx", "b", 1),
    ]
    clash = ("score", "leaks", "toxicity", "changed", "key", "band", "copies", "first", "_text_key", "quality", "toxic", "size", "level", "p")
    df = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(c) for c in clash})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


def ids(rows):
    return sorted((r.doc_id for r in rows), key=lambda x: (x is None, x))
