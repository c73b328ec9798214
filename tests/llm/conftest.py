import pytest

from tallywatch.session import prepare


@pytest.fixture(autouse=True)
def _settings(spark):
    prepare(spark)


@pytest.fixture()
def docs(spark):
    """Documents with nulls, empty and repeated rows, and columns that clash with internal names."""

    def build(rows):
        full = [(i, t, "en", s, len(t or ""), "x", "y") for i, t, s in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, key string, row string")

    return build
