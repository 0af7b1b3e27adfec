import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents rows from texts: ids 0, 1, ..., with further columns of clashing names."""

    def make(texts, source="s", lang="en", ids=None):
        rows = [(ids[k] if ids else k, t, lang, source, len(t or ""), "x", 7) for k, t in enumerate(texts)]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, class_id string, piece int"
        )

    return make
