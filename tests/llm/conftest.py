import pytest

from starmill.llm.common import read_table, share_library
from tests.llm.texts import HARD, SCHEMA


@pytest.fixture(scope="session", autouse=True)
def library(spark):
    share_library(spark)


@pytest.fixture(scope="session")
def hard(spark):
    """Documents with nulls, empty and long texts, repeated rows and ids, and other columns."""
    return spark.createDataFrame(HARD, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark, folder):
    return read_table(spark, folder, "documents")


@pytest.fixture(scope="session")
def texts(small):
    return {r["doc_id"]: r["text"] for r in small.collect()}
