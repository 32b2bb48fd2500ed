import pytest


@pytest.fixture(scope="module")
def make(spark):
    """A table from rows and a DDL schema, dealt over several partitions."""

    def build(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts) if rows else spark.createDataFrame([], schema)

    return build
