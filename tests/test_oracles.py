"""Every registered query with SQL gives what the SQL gives."""

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"
NO_SQL = sorted(set(entry.queries()) - set(entry.oracle_sql()))


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, db, name):
    assert differences(spark, db, entry.queries()[name], entry.oracle_sql()[name], FOLDER) == []


@pytest.mark.parametrize("name", NO_SQL)
def test_gives_rows(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["snp", "statistic", "dof", "p_value", "p_fdr", "significant"]
