"""Every registered query against its DuckDB oracle (rows, columns, values)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_check import compare
from pageflow.registry import QUERIES as REGISTERED

QUERIES = sorted(REGISTERED)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["path", "total_hits", "records"]
    assert len(df.collect()) > 0


def test_every_query_has_oracle_or_is_listed():
    assert set(REGISTERED) <= set(E.queries()) and set(REGISTERED) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", QUERIES)
def test_query_matches_oracle(spark, key):
    res = compare(spark, SF_SMALL, [key], verbose=False)[key]
    assert res[0] in ("ok", "rows-only"), res
