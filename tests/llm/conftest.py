import pytest

from pricetide.llm.store import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def docs_of(spark):
    """Documents from texts, or from (doc_id, text) pairs; with columns whose names clash."""

    def make(texts, sources=None):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        sources = sources or ["s"] * len(rows)
        full = [(i, t, "en", s, len(t or ""), "x", 7) for (i, t), s in zip(rows, sources, strict=True)]
        schema = "doc_id long, text string, lang string, source string, n_chars long, __row string, shard int"
        return spark.createDataFrame(full, schema)

    return make
