"""Every query with an oracle matches DuckDB on the sf0.001 tables."""

import pytest
from oracle import compare

from __spark_entry__ import oracle_sql, queries
from conftest import SF_SMALL

KEYS = sorted(oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck_small, key):
    df = queries()[key](spark, SF_SMALL)
    problems, _ = compare(df, duck_small, oracle_sql()[key])
    assert not problems, problems


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    from __spark_entry__ import entry

    rows = entry(spark).collect()
    assert len(rows) > 0
