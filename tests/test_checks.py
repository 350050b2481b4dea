"""Every registered query against SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_module
from checks.compare import check
from checks.oracle import ORACLE
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
NAMES = list(QUERIES)

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_every_query_has_sql():
    assert set(ORACLE) == set(NAMES)
    assert set(NAMES) <= set(entry_module.queries())
    assert set(NAMES) <= set(entry_module.oracle_sql())


def test_entry(spark):
    assert entry_module.entry(spark).count() == 1


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    assert check(spark, FOLDER, name) is None
