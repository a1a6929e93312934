"""Every registered query against its SQL over the smallest given tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not at hand")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    assert "BAD" not in (out := compare(spark, con, FOLDER, name, entry.queries(), entry.oracle_sql())), out


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
