"""Every registered query against its SQL counterpart, over whole tables."""

import pytest
from compare import connect, difference, spark_answer, sql_answer

from __spark_entry__ import entry, oracle_sql, queries
from rowgate.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_every_query_of_the_core_has_sql_and_no_sql_lacks_a_query():
    assert set(REGISTRY) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_sql(spark, db, name):
    frame = queries()[name](spark, SF)
    allowed = ("string", "bigint", "int", "double", "boolean", "date", "timestamp_ntz")
    assert all(kind in allowed for _, kind in frame.dtypes), frame.dtypes
    answer = spark_answer(frame)
    assert answer[1], "a query without rows checks nothing"
    assert difference(answer, sql_answer(db, oracle_sql()[name])) is None


def test_entry(spark):
    assert entry(spark).columns == ["import_id", "error_code", "error_count"]
