"""Shared by the tests of this folder (a second conftest would hide the one above)."""
import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of texts, with columns whose names operators use themselves."""
    def make(texts, start=1):
        rows = [(i, t, "en", "s", 0, 0.5, "x", "y", "z", "w") for i, t in enumerate(texts, start)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, items string, base string, label string, id string")
    return make

