"""Profiling operators: shape, numeric summaries, categorical distincts.

A profile is made of aggregates over the tables as they are: nothing is
stacked, and no value moves in a shuffle. Moments are plain aggregates; exact
percentiles are selected by mergeable sketches and counts (see
:func:`select_ranks`); distinct values come from a sketch that is exact for
columns with few of them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.fixed import VIDEO_GAME
from marquee.functions.exprs import int_mean, mean_rating
from marquee.operators.arrays import stringify_arrays

SUMMARY_STATS = ("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")
DESCRIBE_STATS = ("count", "mean", "stddev", "min", "max")
MOST_DISTINCT = 200
PERCENTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}


def dataset_info(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: name, number of columns, number of rows."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"))
               .select(F.lit(name).alias("table_name"),
                       F.lit(len(df.columns)).cast("int").alias("n_columns"), "n_rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def preview(df: DataFrame, order: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``order``, shown when a table is profiled (a
    display limit); lists as text."""
    return stringify_arrays(df.orderBy(order).limit(n))


def column_info(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column: table, position, column, type and non-NULL values."""
    parts = []
    for name, df in tables.items():
        counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
        cells = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                                   F.lit(f.dataType.simpleString()).alias("column_type"),
                                   F.col(f.name).alias("n_values"))
                          for i, f in enumerate(df.schema.fields)])
        parts.append(counts.select(F.lit(name).alias("table_name"), F.inline(cells)))
    return _union_all(parts)


def numeric_columns(df: DataFrame) -> list[str]:
    """Integer and double columns (long and float are left out, as profiled)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.IntegerType, T.DoubleType))]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- numeric columns ---------------------------------------------------------

#: Values a column's bracket may hold to be settled by collecting them.
SETTLED = 2_000
#: The sketch's accuracy: a percentile's rank is off by 1 in this many at most.
ACCURACY = 2_000

Cell = tuple[str, str]  # table, column


def _one_pass(tables: dict[str, DataFrame], wanted: dict[Cell, dict[str, Column]]) -> dict[Cell, dict[str, Any]]:
    """Aggregates (cell -> name -> expression) of all tables in one job, with
    one scan for each table; a row of a struct for each column comes back."""
    parts, keys = [], {}
    for table, df in tables.items():
        cells = [c for c in wanted if c[0] == table]
        if not cells:
            continue
        names = [(cell, name) for cell in cells for name in wanted[cell]]
        keys[table] = names
        found = df.agg(*[wanted[cell][name].alias(f"_{i}") for i, (cell, name) in enumerate(names)])
        listed = [F.transform(F.col(f"_{i}"), lambda x: x.cast("double"))
                  if isinstance(f.dataType, T.ArrayType) else F.array(F.col(f"_{i}").cast("double"))
                  for i, f in enumerate(found.schema.fields)]
        parts.append(found.select(F.lit(table).alias("table_name"), F.array(*listed).alias("found")))
    out: dict[Cell, dict[str, Any]] = {}
    for row in _union_all(parts).collect() if parts else ():  # a row for each table
        for (cell, name), values in zip(keys[row["table_name"]], row["found"]):
            out.setdefault(cell, {})[name] = values
    return out


@dataclass
class _Search:
    """The wanted value is the ``rank``-th smallest. ``below`` values are less
    than ``low``, and it lies from ``low`` to ``high`` (None: no bound yet)."""

    rank: int
    low: float | None = None
    high: float | None = None
    below: int = 0
    found: float | None = None


def select_ranks(tables: dict[str, DataFrame], ranks: dict[Cell, dict[str, int]],
                 settled: int = SETTLED, accuracy: int = ACCURACY) -> dict[Cell, dict[str, float]]:
    """The values of given ranks (from 1) among the columns' non-NULL values,
    by distributed selection.

    Each round makes two passes of aggregates over the tables. In the first a
    mergeable quantile sketch of the values inside a rank's bracket names two
    values around it; the second counts exactly what lies below and up to
    them, which makes the bracket smaller by the sketch's accuracy. A bracket
    of few values is settled by collecting them; one end alone may be it
    already, as with a value that fills most of a column. So a column of any
    size and any number of distinct values takes a logarithmic number of
    rounds, and only counts, sketches and a bounded list leave a task.
    """
    searches = {(cell, name): _Search(rank) for cell, some in ranks.items() for name, rank in some.items()}

    def inside(key) -> Column:
        s, value = searches[key], F.col(key[0][1]).cast("double")
        kept = F.lit(True) if s.low is None else (value >= s.low) & (value <= s.high)
        return F.when(kept, value)

    def ask(exprs: dict) -> dict:
        wanted: dict[Cell, dict[str, Column]] = {}
        for key, columns in exprs.items():
            for name, e in columns.items():
                wanted.setdefault(key[0], {})[f"{key[1]} {name}"] = e
        got = _one_pass(tables, wanted)
        return {key: {name: got[key[0]][f"{key[1]} {name}"] for name in columns} for key, columns in exprs.items()}

    sizes = {k: r["n"][0] for k, r in ask({k: {"n": F.count(inside(k))} for k in searches}).items()}
    while open_ := [k for k, s in searches.items() if s.found is None]:
        few = [k for k in open_ if sizes[k] <= settled]
        for key, row in ask({k: {"all": F.array_sort(F.collect_list(inside(k)))} for k in few}).items():
            searches[key].found = row["all"][searches[key].rank - searches[key].below - 1]
        many = [k for k in open_ if k not in few]
        if not many:
            continue
        around = {}
        for key in many:
            share = (searches[key].rank - searches[key].below) / sizes[key]
            around[key] = [min(1.0, max(0.0, share + d / accuracy)) for d in (-2, 0, 2)]
        sketched = ask({k: {"at": F.percentile_approx(inside(k), around[k], accuracy)} for k in many})
        tried = {k: sorted(set(row["at"])) for k, row in sketched.items()}
        value = {k: F.col(k[0][1]).cast("double") for k in many}
        counted = ask({k: {f"{how} {i}": F.count(F.when(value[k] < c if how == "below" else value[k] <= c, 1))
                           for i, c in enumerate(tried[k]) for how in ("below", "upto")} for k in many})
        for key in many:
            s, upper = searches[key], s_upto(searches[key], sizes[key])
            for i, c in enumerate(tried[key]):
                below, upto = int(counted[key][f"below {i}"][0]), int(counted[key][f"upto {i}"][0])
                if below < s.rank <= upto:
                    s.found = c
                elif upto < s.rank and upto >= s.below:  # strictly above c
                    s.low, s.below = math.nextafter(c, math.inf), upto
                elif s.rank <= below and below <= upper:
                    s.high, upper = math.nextafter(c, -math.inf), below
            if s.found is None:
                s.low = -math.inf if s.low is None else s.low
                s.high = math.inf if s.high is None else s.high
                sizes[key] = upper - s.below
    return {cell: {name: searches[cell, name].found for name in some} for cell, some in ranks.items()}


def s_upto(search: _Search, size: float) -> int:
    """Values up to the bracket's upper end."""
    return search.below + int(size)


def _summaries(tables: dict[str, DataFrame], chosen: dict[str, list[str]], stats: Sequence[str]) -> list[tuple]:
    """(table, column, stat, value) of the chosen columns."""
    def moments(c: str) -> dict[str, Column]:
        v = F.col(c).cast("double")
        return {"count": F.count(v), "mean": F.round(F.avg(v), 6), "stddev": F.round(F.stddev_samp(v), 6),
                "min": F.min(v), "max": F.max(v)}
    cells = [(t, c) for t, cs in chosen.items() for c in cs]
    found = _one_pass(tables, {cell: moments(cell[1]) for cell in cells})
    rows = {cell: {name: v[0] for name, v in values.items()} for cell, values in found.items()}
    asked = {k: p for k, p in PERCENTILES.items() if k in stats}
    filled = {cell: {k: max(1, math.ceil(p * r["count"])) for k, p in asked.items()}
              for cell, r in rows.items() if r["count"]}
    if asked and filled:
        for cell, values in select_ranks(tables, filled).items():
            rows[cell].update(values)
    return [(*cell, stat, rows[cell].get(stat)) for cell in cells for stat in stats]


def summarize(df: DataFrame, columns: Sequence[str],
              stats: Sequence[str] = SUMMARY_STATS) -> DataFrame:
    """Long form (column_name, stat, value) of the chosen statistics.

    Mean and sample deviation are rounded to 6 decimals (summation order of
    doubles is not fixed). NULLs are not counted; a column of NULLs yields
    count 0 and NULL for the rest. Percentiles are exact (``percentile_disc``:
    the smallest value whose cumulative share reaches p).
    """
    rows = [r[1:] for r in _summaries({"": df}, {"": list(columns)}, stats)]
    return df.sparkSession.createDataFrame(rows, "column_name string, stat string, value double")


def numeric_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """``summary()`` of every integer/double column of every table, long form.

    The passes over the tables are aggregates; their results, some values for
    each column, make up the rows.
    """
    spark = next(iter(tables.values())).sparkSession
    chosen = {t: numeric_columns(df) for t, df in tables.items()}
    return spark.createDataFrame(_summaries(tables, chosen, SUMMARY_STATS),
                                 "table_name string, column_name string, stat string, value double")



# --- string columns ----------------------------------------------------------

#: Values that the sketch of a column keeps; columns with fewer are counted exactly.
TRACKED = 1_024


def categorical_distincts(tables: dict[str, DataFrame], *, max_distinct: int = 20,
                          sample_size: int = 5) -> DataFrame:
    """String columns with at most ``max_distinct`` distinct values (NULL is one).

    One job with one scan a table: a frequent-items sketch of each column,
    which merges, holds a bounded number of values and is exact while a column
    has fewer distinct ones than it tracks. A column of ids overflows its
    sketch, which then does not account for all rows, and never moves its
    values. Sample = the first ``sample_size`` sorted non-NULL values.
    ``max_distinct`` above ``MOST_DISTINCT`` is refused.
    """
    if not 0 <= max_distinct <= MOST_DISTINCT:
        raise ValueError(f"max_distinct must be 0 to {MOST_DISTINCT}")
    parts = []
    for t, df in tables.items():
        names = string_columns(df)
        if not names:
            continue
        found = df.agg(F.count(F.lit(1)).alias("n"), *[
            F.call_function("approx_top_k", F.col(c), F.lit(MOST_DISTINCT + 1), F.lit(TRACKED)).alias(f"k_{i}")
            for i, c in enumerate(names)])
        cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"k_{i}").alias("kinds"))
                          for i, c in enumerate(names)])
        parts.append(found.select(F.lit(t).alias("table_name"), "n", F.inline(cells)))
    if not parts:
        return next(iter(tables.values())).sparkSession.createDataFrame(
            [], "table_name string, column_name string, distinct_count bigint, sample string")
    rows = F.aggregate("kinds", F.lit(0).cast("bigint"), lambda total, x: total + x["count"])
    values = F.array_sort(F.filter(F.transform("kinds", lambda x: x["item"]), lambda x: x.isNotNull()))
    return (_union_all(parts).where((rows == F.col("n")) & F.size("kinds").between(1, max_distinct))
            .select("table_name", "column_name", F.size("kinds").cast("bigint").alias("distinct_count"),
                    F.concat_ws(", ", F.slice(values, 1, sample_size)).alias("sample")))


def runtime_rating_corr(basics: DataFrame, ratings: DataFrame) -> DataFrame:
    """Pearson r of runtime (int) and rating (float32) over rated titles; one row.

    NULL (not an error) when there are no rows or either side is constant.
    """
    rows = (basics.select("tconst", F.col("runtimeMinutes").cast("int").alias("x"))
            .join(ratings.select("tconst", F.col("averageRating").cast("float").alias("y")),
                  "tconst")
            .where(F.col("x").isNotNull() & F.col("y").isNotNull()))
    # corr() divides by zero under ANSI mode on a constant side, and a CASE
    # around it does not help (the aggregate is evaluated first), so the
    # quotient is formed here with try_divide.
    r = F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y"))
    return rows.agg(F.round(r, 6).alias("correlation"))


def title_type_profile(basics: DataFrame) -> DataFrame:
    """Titles and mean runtime per type (0.0 when no runtime is known)."""
    mean = F.coalesce(int_mean("runtimeMinutes"), F.lit(0.0))
    return (basics.groupBy("titleType")
            .agg(F.count(F.lit(1)).alias("count"), mean.alias("_m"))
            .select("titleType", "count",
                    F.when(F.col("titleType").isNull(), F.lit(0.0)).otherwise(F.col("_m"))
                    .alias("average_runtime")))


def subset_means(basics: DataFrame, ratings: DataFrame, *,
                 title_type: str = VIDEO_GAME) -> DataFrame:
    """Mean rating and mean votes over rated titles of one type; one row."""
    rows = basics.where(F.col("titleType") == title_type).select("tconst").join(ratings, "tconst")
    return rows.agg(mean_rating("averageRating").alias("avg_rating"),
                    int_mean("numVotes").alias("avg_votes"))
