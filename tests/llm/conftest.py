from __future__ import annotations

import random

import pytest

WORDS = ["alpha", "beta", "gamma", "delta", "eta", "theta", "iota", "kappa", "é", "zeta", "nu", "xi", "pi", "rho"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls everywhere, empty and long texts, ties, repeated rows, extra columns with names that operators use."""
    rng = random.Random(7)
    text = lambda n: " ".join(rng.choice(WORDS) + rng.choice(["", "", ".", ",\n"]) for _ in range(n))
    base = text(120)
    rows = [
        (1, base, "en", "a"),
        (1, base, "en", "a"),
        (1, text(30), "en", None),
        (2, base, None, "b"),
        (3, base + " " + text(80), "de", "b"),
        (4, None, "en", "a"),
        (5, "", "de", None),
        (6, " \n\t ", None, None),
        (None, base, "en", "c"),
        (None, None, None, None),
        (7, text(4), "en", "c"),
        (8, text(6000), "en", "d"),
        (9, text(200) + " " + base, "de", "é"),
        (10, "x" * 5000, "en", "d"),
    ]
    rows = [(*r, None if r[1] is None else len(r[1]), "k", 1, "t") for r in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kind string, size int, taken string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
