"""Every registered query against its SQL check in DuckDB."""

import pytest

from __spark_entry__ import entry
from millrace.oracle.sql import all_sql
from millrace.registry import QUERIES
from verify import compare, connect

from conftest import SMALL, plan_of

SQL = all_sql()

# Results that SQL does not determine: any k rows, estimates, Spark's own hash.
ROWS_ONLY = {
    "limit_sample", "chk_weblog_sample", "column_cardinality", "agg_count_distinct_estimate", "bucket_sample",
}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_a_check():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    query = QUERIES[name](spark, SMALL)
    plan = plan_of(query)
    for avoided in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert avoided not in plan
    mine = query.toPandas()
    assert len(mine) > 0
    if name in SQL:
        assert compare(mine, duck.execute(SQL[name]).df()) is None


def test_entry(spark):
    assert entry(spark).columns == [
        "request_hour", "status_class", "total_requests", "unique_visitors", "total_bytes_served",
        "avg_response_size_bytes", "min_status_code", "max_status_code",
    ]
