import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents with extra columns whose names clash with those of results and of inner steps."""

    def made(rows):
        rows = [(i, t, "en", "s", len(t or ""), 1, "x", 2, 3.0) for i, t in rows]
        return spark.createDataFrame(rows, SCHEMA + ", n_tokens int, id string, shard int, score double")

    return made


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
