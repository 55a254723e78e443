import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, spans string, kept string, node string, label int, media binary, ids string"
LONG = " ".join(f"w{k % 977}x{k % 89}" for k in range(12_000))


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in any column, empty, blank and very long texts, repeated rows, and extra columns with clashing names."""
    texts = [(1, None), (2, ""), (3, "one"), (3, "one"), (None, "two words"), (None, None), (4, LONG), (5, LONG), (6, " \t\n "), (7, "Ünï cödé 漢字 😀 text\nsecond line."), (8, "é" * 300)]
    rows = [(i, t, None, None, None if t is None else len(t), 1.0, "s", "k", "n", 1, None, "i") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def rng():
    return random.Random(7)


def invented(rng, n, words="the of and thion reble ounder ingly easter stone hand lywh".split()):
    return " ".join(rng.choice(words) + rng.choice(words) for _ in range(n))
