"""Every query of the collection engine against DuckDB on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from ledgerfold.plans.oracle import all_sql
from ledgerfold.plans.queries import all_queries
from tests.compare import compare, duckdb_views
from tests.conftest import TESTDATA

SF_DIR = os.environ.get("ORACLE_SF_DIR", f"{TESTDATA}/sf0.001")
# Right only when empty, or empty on the smallest tables.
MAY_BE_EMPTY = {"axis_value_overlap", "collisions_folded", "path_set_difference", "path_set_intersection"}

# A fit by steps has no SQL; tests/test_trained.py holds it against numpy and held-out rows.
WITHOUT_SQL = {"classify_trained"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return duckdb_views(SF_DIR)


def test_every_query_has_its_sql():
    assert set(all_queries()) - WITHOUT_SQL == set(all_sql())


def test_all_are_registered():
    assert set(all_queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_query(spark, duck, name):
    verdict = compare(spark, duck, all_queries()[name], all_sql()[name], SF_DIR)
    assert verdict == "" or verdict == "EMPTY" and name in MAY_BE_EMPTY


def test_entry(spark):
    assert entry.entry(spark).count() == 12
