import pytest


@pytest.fixture(scope="session", autouse=True)
def one_checkpoint_folder(spark):
    """Tables of the tests go to one temporary folder."""
    from tidemark.workspace import shared_folder

    shared_folder(spark)


@pytest.fixture
def docs(spark):
    """A documents table from texts, ids counting up; extra columns whose names operators use inside."""

    def make(*texts):
        rows = [(n, text, "en", "s", 0, 1, 2) for n, text in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long, node long, label long")

    return make
