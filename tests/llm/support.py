import pytest

from tallystock.llm.ship import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with an extra column."""
    return lambda data: spark.createDataFrame([(d, t, "x") for d, t in data], "doc_id long, text string, extra string")
