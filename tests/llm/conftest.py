import pytest

from edge_rows import COLUMNS, EDGE, rows_of  # noqa: I001

@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts):
        return spark.createDataFrame(rows_of(texts), COLUMNS)

    return make


@pytest.fixture(scope="session")
def edge(make_docs):
    return make_docs(EDGE)


@pytest.fixture(scope="session")
def nothing(make_docs):
    return make_docs([])


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
