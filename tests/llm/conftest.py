from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def shipped(spark):
    """The session, with the package sent to its workers."""
    from tickloom.llm.shipping import ship

    ship(spark)
    return spark


DOCS = "doc_id long, text string, lang string, id long, key string, n_words long, score double, dropped string, ids string"


@pytest.fixture(scope="session")
def odd_docs(shipped):
    """NULLs, empty and blank texts, a very long text, repeated rows, extra columns with clashing names."""
    long_text = " ".join(f"word{i % 997} and{i % 31}" for i in range(60_000))
    texts = [None, "", "  \n ", "Hello there.", "Hello there.", long_text, "a@b.co +1 (269) 555-3296 4111 1111 1111 1111", "Ünï çödé 漢字 😀"]
    rows = [(i, t, "en", 7, "k", 1, 0.5, "d", "i") for i, t in enumerate(texts)]
    rows += [rows[3], (None, "no id", None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return shipped.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
