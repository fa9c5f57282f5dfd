"""Every registered query against its SQL, all rows and values."""

import pytest

import __spark_entry__ as entry
from catalog import queries as registered
from catalog import views
from catalog.compare import connect, difference

SF = "/root/testdata/sf0.001"
QUERIES, SQL = dict(registered.REGISTRY), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_each_query_has_sql():
    assert {k for k in QUERIES if k in registered.REGISTRY} <= set(SQL)


@pytest.mark.parametrize("key", QUERIES)
def test_query_equals_sql(spark, con, key):
    assert difference(QUERIES[key](spark, SF), con, SQL[key]) is None


def test_views_keep_every_row(spark):
    for name, view in (("part", views.details), ("supplier", views.stores), ("lineitem", views.deals)):
        assert view(spark, SF).count() == views.table(spark, SF, name).count()


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["snapshot_date", "maker_name"]
