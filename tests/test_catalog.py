"""Every query with SQL gives the SQL's rows on the smallest tables; the others run."""

import os

import pytest

from sastra.plans import catalog
from tests.sqlcheck import FOLDER, connection, differences

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connection()


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_equals_sql(spark, con, name):
    assert differences(con, catalog.oracle_sql()[name], catalog.queries()[name](spark, FOLDER)) == ({}, {})


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_runs(spark, name):
    assert catalog.queries()[name](spark, FOLDER).count() > 0
