"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import canonical, duck

import __spark_entry__ as entry_points
from rowmill.plans import all_oracles, all_queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return duck(FOLDER)


def test_every_query_has_a_check():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, database, name):
    result = all_queries()[name](spark, FOLDER)
    expected = database.execute(all_oracles()[name])
    columns = [column[0] for column in expected.description]
    assert canonical(result.columns, result.collect()) == canonical(columns, expected.fetchall())


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert len(rows) == 5
    assert [r.avg_price for r in rows] == sorted((r.avg_price for r in rows), reverse=True)
