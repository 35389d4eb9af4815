import pytest

from plazalens.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """Rows as documents, with columns whose names an operator may use itself."""

    def make(rows):
        columns = "doc_id long, text string, lang string, source string, n_chars long, key string, size string, hash string, node string, id string, a string"
        filled = [(*row, *[None] * (5 - len(row)), *["x"] * 6) for row in rows]
        return spark.createDataFrame(filled, columns)

    return make
