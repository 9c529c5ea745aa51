import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) rows, with extra and clashing columns."""
    def make(rows):
        rows = [(i, t, "en", "src0", len(t or ""), "x", 1) for i, t in rows]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, component_id string, score int")
    return make
