import pytest


@pytest.fixture(scope="session")
def make(spark):
    """A table of rows with a schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
