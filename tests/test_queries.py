"""Every query with SQL gives the values of its SQL in DuckDB, on the smallest tables."""

import os
from dataclasses import replace

import pytest

from verification import oracles, queries
from verification.compare import connect, difference
from verification.fixture import Fixture
from verification.queries import registered

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
SQL = oracles.sql()


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_statement_has_a_query():
    assert set(SQL) <= set(registered())


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal_to_sql(spark, db, name):
    frame = registered()[name](spark, FOLDER).toPandas()
    assert difference(frame, db.execute(SQL[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(registered()) - set(SQL)))
def test_runs(spark, name):
    assert registered()[name](spark, FOLDER).count() > 0


@pytest.mark.parametrize(
    "name", ["top_quarter", "top_medians", "score_quantiles", "scored_clients", "sample_n"]
)
def test_ways_for_large_groups_equal_sql(spark, db, name):
    """The same queries when no group fits a task and no sample is small."""
    fixture = Fixture(spark, FOLDER)
    fixture.settings = replace(
        fixture.settings, group_rows_in_task=1, sketch_accuracy=20, small_table_rows=70
    )
    frame = queries.build(name)(fixture).toPandas()
    assert difference(frame, db.execute(SQL[name]).df()) is None
