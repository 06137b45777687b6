"""Shared cases of the text operators' tests."""
import random

import pytest

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b for a in "ba ce di fo gu la me ni po ru".split()
         for b in "n r st l m k p t s v".split()]


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long = prose(1, 30_000)
    rows = [(1, prose(2, 40)), (2, None), (3, ""), (4, "  \n\t "), (5, long), (6, prose(2, 40)),
            (7, prose(3, 60)), (7, prose(3, 60)), (None, prose(4, 50)), (None, None),
            (8, "one"), (9, "naïve Été \U0001f600 <|endoftext|> it's 12"),
            (10, "one one one one one one")]
    out = [(i, t, "en", f"s{k % 3}", len(t or "")) for k, (i, t) in enumerate(rows)]
    out[0] = (1, rows[0][1], None, None, None)
    return out


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with extra columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    extra = ("score", "words", "id", "text_key", "c0", "size", "target", "ids", "n", "range")
    return df.withColumns({c: F.lit("x") for c in extra})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
