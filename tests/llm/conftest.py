import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents table from (doc_id, text) pairs, with extra columns whose
    names the operators use themselves."""
    def make(pairs, parts=3):
        rows = [(i, t, "en", "s", len(t or ""), "x", 1) for i, t in pairs]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, row string, score int"
        ).repartition(parts)
    return make
