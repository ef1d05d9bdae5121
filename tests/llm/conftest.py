import pytest

CLASHES = "row long, size long, n_lines string, copies int, score double, group string, key string, th long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Builds documents from (doc_id, text, source) rows, with extra columns that operators use themselves."""
    def build(rows):
        return spark.createDataFrame(
            [(*r, 1, 2, "x", 3, 0.5, "g", "k", 4) for r in rows],
            f"doc_id long, text string, source string, {CLASHES}")
    return build
