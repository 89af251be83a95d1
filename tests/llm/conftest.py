import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(200)) for _ in range(n))


@pytest.fixture(scope="session")
def rng():
    return random.Random(7)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows and ids."""
    rng = random.Random(3)
    long = prose(rng, 9000)
    same = prose(rng, 120)
    rows = [(1, same, "en", "a"), (1, same, "en", "a"), (2, same, None, "a"), (2, prose(rng, 80), "en", None),
            (3, None, "en", "a"), (4, "", "en", "b"), (None, prose(rng, 60), "en", "b"), (None, None, None, None),
            (5, long, "en", "b"), (6, " \n\t ", "en", "b"), (7, "...\n---\n", "en", "b"),
            (8, same.replace(same.split()[50], "other"), "en", "a"), (9, "Ünï çödé 你好 🙂 \U0001F600", "de", "c"),
            (10, "a", "en", "c"), (11, "x" * 3000, "en", "c"), (12, "ha " * 500, "en", "c")]
    return [(*r, len(r[1]) if r[1] is not None else None) for r in rows]


CLASHING = ["key", "hash", "spans", "score", "gone", "host", "w", "n_words", "pos", "th", "__score_", "line", "st"]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows with extra columns whose names operators might use themselves."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(odd_rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("extra") for c in CLASHING})


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
