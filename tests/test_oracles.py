"""Every registered query against its SQL; queries without SQL must give rows."""

import pytest

import __spark_entry__ as contract
from tests.oracle import compare

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLES:
        assert compare(df, duck, ORACLES[name]) is None
    else:
        assert df.limit(1).count() == 1


def test_entry(spark):
    assert contract.entry(spark).count() == 200
