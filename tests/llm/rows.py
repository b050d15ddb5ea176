from __future__ import annotations

import pytest


@pytest.fixture
def rows_of(spark):
    """A small table from tuples, over several partitions."""
    def make(rows, schema):
        return spark.createDataFrame(rows, schema).repartition(3)

    return make
