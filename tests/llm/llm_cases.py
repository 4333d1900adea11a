"""Small tables with the awkward cases every operator must take."""

from __future__ import annotations

import random

import pytest

#: Extra columns whose names operators use inside.
EXTRA = "__id long, fp long, score double, n long, component long, item long, learn boolean, block int"
DOCS = f"doc_id long, text string, {EXTRA}"
CLASH = (1, 2, 0.5, 3, 4, 5, True, 6)


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    out = []
    for i in range(n):
        w = f"w{rng.randrange(vocabulary)}"
        out.append(w.capitalize() if i % 11 == 0 else w)
        out.append(rng.choice([" ", " ", " ", "  ", "\t", ".\n", ", "]))
    return "".join(out)


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents with clashing columns from (doc_id, text) rows."""

    def make(rows):
        return spark.createDataFrame([(i, t, *CLASH) for i, t in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def awkward():
    """Nulls, blanks, repeats, ties, near copies and a very long text."""
    rng = random.Random(5)
    base = prose(rng, 120)
    words = base.split(" ")
    near = " ".join([*words[:60], "changed", *words[61:]])
    long = prose(rng, 30_000, 5000)
    return [
        (None, None), (None, "a null id with some words in it"), (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "ONE"),
        (6, "two words"), (7, base), (8, base), (9, near), (10, base.upper()), (11, long), (12, long + " tail"),
        (13, "same row"), (13, "same row"), (14, "first of two texts under one id"), (14, base), (15, prose(rng, 80)),
        (16, "naïve café ñandú 漢字 😀 ́"), (17, "\n\n\n"), (18, "a shared line of text\nown line number one\n"),
        (19, "A shared line of text \nown line number two\na shared line of text"), (20, "x" * 5000),
    ]
