"""The problems' queries on the smallest tables: the SQL's rows where there is SQL, else that they run."""

import os

import pytest

from sastra.llm import queries as q
from tests.sqlcheck import FOLDER, connection, differences

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_equals_sql(spark, name):
    assert differences(connection(), q.oracle_sql()[name], q.queries()[name](spark, FOLDER)) == ({}, {})


@pytest.mark.parametrize("name", sorted(set(q.queries()) - set(q.oracle_sql())))
def test_runs(spark, name):
    assert q.queries()[name](spark, FOLDER).count() > 0
