"""Every registered key against its DuckDB oracle on the smallest tables.

The driver repeats this at sf 0.01; here it runs at sf 0.001 to stay quick.
"""

import pytest

import __spark_entry__ as entry
from marquee.oracle.compare import compare
from marquee.plans.registry import spark_queries
from tests.conftest import SF_SMALL

KEYS = sorted(spark_queries())
SQL = entry.oracle_sql()


def test_every_key_has_oracle_sql():
    missing = [k for k in KEYS if k not in SQL]
    assert missing == []


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns == ["tconst", "primaryTitle", "startYear", "genres",
                          "averageRating", "numVotes"]


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, duck_small, key):
    df = entry.queries()[key](spark, SF_SMALL)
    out = compare(df, duck_small, SQL[key])
    assert out.ok, f"{key}: rows {out.rows_spark}/{out.rows_oracle}\n{out.detail}"
