import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, block int, score string, label int"


@pytest.fixture(scope="session")
def docs(spark):
    """docs([(doc_id, text[, lang]), ...]): documents with extra columns whose names operators use themselves."""

    def build(rows):
        rows = [(*r, "en")[:3] for r in rows]
        return spark.createDataFrame([(d, t, lang, "src", 7, 3, "s", 1) for d, t, lang in rows], DOCS).repartition(3)

    return build


@pytest.fixture
def words():
    """words(n, seed): n words of a small skewed vocabulary."""

    def make(n, seed=0, size=400):
        rng = random.Random(seed)
        vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randrange(1, 8))) for _ in range(size)]
        return [vocabulary[min(int(rng.paretovariate(0.7)) - 1, size - 1)] for _ in range(n)]

    return make
