"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing names."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row string, `key` string, unit string, score double, `a.b` int"


def passage(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(words))


@pytest.fixture(scope="session")
def texts():
    base = passage(1, 120)
    near = base.split()
    near[60] = "changed"
    rows = [
        (1, base), (2, base.replace(" ", "  \t", 3)), (3, " ".join(near)), (4, passage(2, 80)), (5, None), (6, ""), (7, "  \n "), (8, "one two"),
        (9, "one two"), (9, "one two"), (10, passage(3, 30) + "\n" + passage(4, 60) + "\n" + passage(5, 20)),
        (11, passage(6, 30) + "\n" + passage(4, 60) + "\n" + passage(6, 30)), (12, passage(7, 9000)), (13, passage(7, 9000)),
        (None, passage(8, 70)), (None, base), (None, None), (14, "naïve ćafé 日本語 😀 don't we'll 12³ <|endoftext|> end  \n\n"),
        (15, passage(9, 60).upper()), (15, passage(10, 60))]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i, t, None if n % 5 == 0 else "en", None if n % 3 else "s", n, "x", "k", "u", 0.5, n) for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
