"""Every registered query against its DuckDB oracle on the smallest data set,
plus the driver contract (entry, names, columns)."""

import pytest

import __spark_entry__ as E
from deliverylens.plans import registry
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck

QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


def test_contract():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())
    assert len(QUERIES) >= 90


def test_entry(spark):
    df = E.entry(spark)
    got = df.collect()
    assert len(got) == 1 and got[0]["total_orders"] == 1004


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert ok, msg


def test_sample_is_deterministic_and_bounded(spark):
    a = QUERIES["n16_delay_score_sample"](spark, SF_SMALL).collect()
    b = QUERIES["n16_delay_score_sample"](spark, SF_SMALL).collect()
    assert a == b and 0 < len(a) <= 3000
