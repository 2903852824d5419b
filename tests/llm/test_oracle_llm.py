"""Queries of the subpackage that have SQL, against DuckDB."""

import pytest

import __spark_entry__ as entry
from marquee.llm.queries import SQL
from marquee.llm.registry import llm_queries
from marquee.oracle.compare import compare
from tests.conftest import SF_SMALL


def test_every_operator_and_the_pipeline_is_registered():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_equals_its_sql(spark, duck_small, key):
    out = compare(llm_queries()[key](spark, SF_SMALL), duck_small, SQL[key])
    assert out.ok, f"{key}: rows {out.rows_spark}/{out.rows_oracle}\n{out.detail}"
