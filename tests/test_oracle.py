"""Every registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as entry_module
from compare import compare, connect
from fringeframe.session import clear_tables

QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()
#: Few rows in the smallest tables can leave these without any hit.
MAY_BE_EMPTY = {"str9", "str9_stream", "flt19", "flt22", "jn21", "flt16", "flt16_exact", "flt17", "flt17_exact", "jn12", "flt21"}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_keys():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, sf, con, key):
    clear_tables(spark)
    df = QUERIES[key](spark, sf)
    if key not in ORACLES:
        assert df.count() > 0 or key in MAY_BE_EMPTY
        return
    diff = compare(df, con, ORACLES[key])
    if diff == "EMPTY" and key in MAY_BE_EMPTY:
        return
    assert diff is None


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
