"""Texts and tables that the tests of the corpus operators share."""

import random

import pytest


def sentence(seed: int, n: int) -> str:
    """Invented words, different for every seed."""
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(n))


@pytest.fixture
def docs_of(spark):
    """A documents table from (doc_id, text) pairs, with a column whose name operators use too."""

    def build(pairs):
        rows = [(i, t, "en", "src1", None if t is None else len(t), 1, 2) for i, t in pairs]
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, _r1 int, fp int"
        return spark.createDataFrame(rows, schema)

    return build
