"""Every registered query on the smallest tables, against its SQL where it has one."""

import check_oracles
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return check_oracles.connect(SF_DIR)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, duck, key):
    difference, n = check_oracles.compare(spark, duck, key, QUERIES[key], ORACLES.get(key), SF_DIR)
    assert difference is None, difference
    assert n >= 0


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["region", "bmi", "charges"]
    assert df.count() == 5


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
