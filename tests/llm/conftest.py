import pytest
from pyspark.sql import Row

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, node string, tokens string, copies string"


@pytest.fixture(scope="session")
def docs(spark):
    """``docs([(doc_id, text[, lang[, source]]), ...])``; with extra columns whose names operators use themselves."""

    def make(rows):
        full = []
        for r in rows:
            doc_id, text, lang, source = (*r, *[None] * (4 - len(r)))
            full.append(Row(doc_id, text, lang, source, None if text is None else len(text), "x", "y", "z", "c"))
        return spark.createDataFrame(full, DOCS)

    return make


EDGE_TEXTS = [None, "", " \t\n", "a", "one two three", "x" * 5000, "word " * 3000, "día ñandú 漢字 🙂 " * 40]


@pytest.fixture(scope="session")
def edge_docs(docs):
    """NULL, empty, short, long and repeated rows, and a NULL id."""
    rows = [(i, t, "en", "s") for i, t in enumerate(EDGE_TEXTS)]
    return docs([*rows, rows[4], (None, "no id here at all", None, None)])
