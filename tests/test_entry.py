"""Driver contract: entry() smoke check and every oracle at sf0.01."""

import pytest

import __spark_entry__ as E
from conftest import SF01
from oracle_check import compare, duck

QUERIES = E.queries()
ORACLES = E.oracle_sql()


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.count() == len(duck(E.FLAGSHIP_SF).execute(ORACLES["p1_feature_clicks"]).fetchall())
    assert len(df.columns) == 19


def test_every_oracle_is_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLES[name], SF01, con)
    assert r["spark_rows"] == r["oracle_rows"] and r["hash_match"], r


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, SF01).count() > 0
