import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """documents rows from (doc_id, text) or (doc_id, text, source), with the
    table's other columns and one whose name clashes with inner ones."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1]) if r[1] is not None else None, "x") for r in rows]
        return spark.createDataFrame(full, DOCS + ", node string")
    return make


@pytest.fixture(autouse=True)
def released(spark):
    """What a test caches goes with it: others count what is left in the session."""
    yield
    spark.catalog.clearCache()
