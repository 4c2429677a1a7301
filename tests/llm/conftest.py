"""Odd documents for the operators on texts."""

from __future__ import annotations

import random

import pytest

SCHEMA = "uid string, doc_id long, text string, n_tokens string, kept string, word string, node string, score string"


def words(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdeé") for _ in range(r.randint(2, 7))) for _ in range(n)]


def texts() -> list[tuple[int | None, str | None]]:
    base, passage = words(1, 120), " ".join(words(2, 60))
    near = [*base]
    near[60] = "changed"
    other = words(4, 150)
    rows = [(1, " ".join(base)), (2, " ".join(base)), (3, " ".join(near)), (4, " ".join(near).upper()), (5, " ".join(other)),
            (6, "start " + passage + " end " + " ".join(words(5, 40))), (7, " ".join(words(6, 50)) + "\n" + passage),
            (8, None), (9, ""), (10, " \n\t "), (11, "one two"), (12, "One TWO"), (13, "one two three four five"),
            (14, "again and again " * 300), (15, "x" * 3000), (16, "  blanks   everywhere  \n \n and <|endoftext|> 　 日本語 🙂"),
            (17, " ".join(words(7, 4000))), (None, "a text without an id " * 3), (None, None), (18, " ".join(base)), (18, " ".join(base)),
            (18, "another text with the same id")]
    return rows


@pytest.fixture(scope="session")
def rows():
    return texts()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """Extra columns have names that the operators use themselves."""
    return spark.createDataFrame([("u", i, t, "n", "k", "w", "n", "s") for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
