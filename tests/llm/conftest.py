import pytest


@pytest.fixture
def docs_of(spark):
    """DataFrame (doc_id, text) of given texts, ids from 0."""
    def make(texts, start=0, **extra):
        rows = [(start + i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        return df
    return make
