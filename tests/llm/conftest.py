from __future__ import annotations

import random

import pytest

from ..conftest import scratch, spark  # noqa: F401 - shared fixtures


def _prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(n))


def messy_rows() -> list[tuple]:
    """Nulls in any column, empty and blank texts, copies, near copies, repeated rows, a long text."""
    rng = random.Random(5)
    base = _prose(rng, 160)
    words = base.split()
    near = " ".join(w if i % 40 else "zz" for i, w in enumerate(words))
    passage = _prose(rng, 90)
    texts = [base, base, near, base.upper(), passage + " " + _prose(rng, 60), _prose(rng, 50) + " " + passage, None, "", " \n\t ",
             "one two", "ONE two", "a a a a a a a a " * 60, _prose(rng, 4000) + passage, "ok<|endoftext|>Straße 日本 😀 Σ", "x" * 900]
    rows = [(i * 3, t, ["en", "de", None][i % 3], f"src{i % 2}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return [*rows, rows[4], rows[4], (None, base, "en", "src0", 1), (None, None, None, None, None)]


@pytest.fixture(scope="session")
def messy(spark):  # noqa: F811
    """The rows with extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(messy_rows(), "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("clash") for c in ("rk", "list", "h", "id", "_text", "_key", "g", "token")}).repartition(3)


@pytest.fixture(scope="session")
def none(messy):
    return messy.limit(0)
