"""Small tables for the operators of the training-data pipeline."""

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string"


@pytest.fixture(scope="session")
def docs(spark):
    """Rows of (doc_id, text) as a documents table with a clashing extra column."""
    def make(rows):
        return spark.createDataFrame([(i, t, None, None, None if t is None else len(t), "x") for i, t in rows], DOCS)
    return make
