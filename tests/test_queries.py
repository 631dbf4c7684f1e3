"""Every registered query against its SQL on the smallest tables."""

import pytest
from conftest import SMALL
from oracle import connect, differences

from verdigrid.plans import QUERIES


@pytest.fixture(scope="module")
def duck():
    con = connect(SMALL)
    yield con
    con.close()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_sql(spark, duck, key):
    query = QUERIES[key]
    result = query(spark, SMALL)
    if query.sql:
        assert differences(result, duck, query.sql) is None
    else:
        assert result.count() > 0


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["o_orderpriority", "price_band", "n", "mean_price"]
    assert entry.entry(spark).count() > 0
