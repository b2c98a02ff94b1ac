import os
import random

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    return SF


DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, t int, key string, score double"


def prose(n, seed=0):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["ka", "lo", "mi", "ren", "the", "ou"]) for _ in range(rng.randint(1, 4)))
                    for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing extra columns."""
    long = prose(30000, 1)
    rows = [
        (1, prose(40, 2), "en", "a"), (2, None, "en", "a"), (3, "", None, "a"), (4, prose(40, 2), "de", None),
        (5, long, "en", "b"), (5, long, "en", "b"), (None, prose(30, 3), None, None), (6, " \n\t ", "fr", "b"),
        (7, "one two", "en", "b"), (8, prose(40, 2) + " more", "en", "c"), (9, "Ünï çødé — 😀 ﬁ İ", "en", "c"),
    ]
    return spark.createDataFrame([(i, t, la, s, None if t is None else len(t), "x", 1, "k", None)
                                  for i, t, la, s in rows], DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
