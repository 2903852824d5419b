"""Compare a Spark result with a DuckDB oracle result.

Row count, column names (sorted) and an order-insensitive multiset of rows
are checked. Values are compared exactly: doubles that only agree after
rounding count as a mismatch, as they would in a value hash.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import duckdb

STAR_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in STAR_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_canon(x) for x in v)
    if hasattr(v, "item"):
        return v.item()
    return v


@dataclass
class Outcome:
    rows_spark: int
    rows_oracle: int
    columns_match: bool
    values_match: bool
    detail: str = ""

    @property
    def ok(self) -> bool:
        return (self.rows_spark == self.rows_oracle and self.columns_match
                and self.values_match)


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> Outcome:
    s_cols = list(spark_df.columns)
    s_rows = [tuple(_canon(r[c]) for c in sorted(s_cols)) for r in spark_df.collect()]
    cur = con.execute(sql)
    o_cols = [d[0] for d in cur.description]
    o_raw = cur.fetchall()
    order = sorted(range(len(o_cols)), key=lambda i: o_cols[i])
    o_rows = [tuple(_canon(r[i]) for i in order) for r in o_raw]
    cols_ok = sorted(s_cols) == sorted(o_cols)
    cs, co = Counter(s_rows), Counter(o_rows)
    detail = ""
    if not cols_ok:
        detail = f"columns spark={sorted(s_cols)} oracle={sorted(o_cols)}"
    elif cs != co:
        only_s = list((cs - co).elements())[:3]
        only_o = list((co - cs).elements())[:3]
        detail = f"only spark: {only_s}\nonly oracle: {only_o}"
    return Outcome(len(s_rows), len(o_rows), cols_ok, cs == co, detail)
