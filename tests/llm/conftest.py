import pytest

from changeflow.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def docs(spark):
    """(doc_id, text) pairs as a table with the columns of documents and some that clash
    with working names."""

    def build(rows, extra=True):
        schema = "doc_id long, text string"
        if extra:
            rows = [(*r, "en", "src0", len(r[1] or ""), -1, "mine", None) for r in rows]
            schema += ", lang string, source string, n_chars long, id int, row string, kept string"
        return spark.createDataFrame(rows, schema).repartition(3)

    return build
