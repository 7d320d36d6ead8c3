"""Every query against its SQL on the smallest driver tables."""

import os

import pytest

from check import database, difference, spark_rows, sql_rows
from episeries.workloads import WORKLOADS

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


@pytest.fixture(scope="module")
def db():
    return database(SF)


@pytest.mark.parametrize("name", sorted(WORKLOADS))
def test_query_agrees_with_sql(spark, db, name):
    work = WORKLOADS[name]
    assert work.sql, "a query needs its SQL"
    assert difference(spark_rows(work.run(spark, SF)), sql_rows(db, work.sql)) == ""
