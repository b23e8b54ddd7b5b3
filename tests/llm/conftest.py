import pytest


@pytest.fixture
def docs(spark):
    """Makes a documents table from (doc_id, text) rows."""

    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", "s", None) for i, t in rows],
            "doc_id long, text string, lang string, source string, n_chars long",
        )

    return make
