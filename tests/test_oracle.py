"""Each query against its SQL twin, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import duck, spark_rows, sql_rows
from paywarden.registry import ORACLE, QUERIES
from tests.conftest import plan


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


# Nothing of this may be in the plan of a query: pairs of everything, or Python per row.
FORBIDDEN = ["CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow", "MapPartitions"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, sf, con, name):
    result = queries()[name](spark, sf)
    assert [node for node in FORBIDDEN if node in plan(result)] == []
    assert spark_rows(result) == sql_rows(con, ORACLE[name])


def test_every_query_has_its_sql_twin():
    assert set(ORACLE) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


def test_entry_scores_every_event(spark, sf):
    result = entry(spark)
    assert result.count() == spark.read.parquet(f"{sf}/events.parquet").count()
    assert {"prediction", "notify_user", "userid"} <= set(result.columns)
