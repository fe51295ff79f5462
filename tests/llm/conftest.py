import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Builds a documents table from (doc_id, text) pairs."""

    def build(rows, parts=3):
        full = [(i, t, "en", f"s{k % 3}", len(t) if t is not None else None) for k, (i, t) in enumerate(rows)]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").repartition(parts)

    return build
