import pytest


@pytest.fixture
def docs(spark):
    """A table of documents from (id, text) rows, with columns that operators must not mind."""

    def make(rows):
        return spark.createDataFrame(
            [(i, t, "x", 1, "k") for i, t in rows],
            "doc_id long, text string, n_words string, ref long, _row string",
        )

    return make
