
import pytest

import __spark_entry__ as E
from threadmill.plans.catalog import ORACLE_SQL, QUERIES
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    _, ok, n_spark, n_duck, _ = compare(spark, con, name, QUERIES[name], ORACLE_SQL[name], SF)
    assert n_spark and n_spark > 0, "each oracle query must return rows"
    assert ok, f"{name}: spark={n_spark} duck={n_duck}"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["conv_id", "word", "n"]
    assert df.count() > 0
