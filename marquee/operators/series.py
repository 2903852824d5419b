"""Ordered-series operators: running means, previous values, child counts.

A window over an open-ended text key (a series or game title) sends each key
to one task. Here rows are dealt out once, in ranges along (key, position), and
each range continues with what the ranges before it carry over. So a key with
a third of all rows is split across tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.exprs import exact, mean_from_sum
from marquee.operators.agg import materialize
from marquee.operators.ranges import RANGE, Ranges


def running_mean_rating(df: DataFrame, key: str, order: Sequence[str], rating: str,
                        out: str) -> DataFrame:
    """Running mean of ``rating`` per ``key`` along ``order`` (ascending, NULLs first).

    Same frame as ``avg(rating) OVER (PARTITION BY key ORDER BY order)``: RANGE
    from the start to the current row, so rows with equal positions (peers)
    share one value; peers are never split between ranges. The sums are exact,
    and a range adds what its first key had before it. The result is in order.
    """
    exactly = F.coalesce(exact(rating), F.lit(0).cast("decimal(12,6)"))
    known = F.when(F.col(rating).isNotNull(), 1).otherwise(0)
    cut = Ranges(materialize(df), [key, *order], keys=1)
    before = cut.carried({"s": (1, exactly), "n": (1, known)})
    inside = cut.begins_inside(1)
    start = lambda name, kind: F.when(inside, cut.value_of([r[name] for r in before], kind)).otherwise(
        F.lit(0).cast(kind))
    w = Window.partitionBy(RANGE, key).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    total = (F.sum(exactly).over(w) + start("s", "decimal(22,6)")).alias("_s")
    n = (F.sum(known).over(w) + start("n", "bigint")).alias("_n")
    return (cut.dealt().select("*", total, n).withColumn(out, mean_from_sum(F.col("_s"), F.col("_n")))
            .select(*df.columns, out))


def previous_value(df: DataFrame, key: str, order: Sequence[str], value: str,
                   out: str) -> DataFrame:
    """``lag(value)`` per ``key`` along ``order`` (ascending, NULLs first).

    ``order`` must be total within a key (end it with an id). Only the last
    row of a range goes to the next one; the rows themselves move once.
    """
    cut = Ranges(materialize(df), [key, *order], keys=1)
    ends = cut.last(value)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    w = Window.partitionBy(RANGE).orderBy(*[F.col(c).asc_nulls_first() for c in cut.order])
    before = lambda c: F.when(F.row_number().over(w) > 1, F.lag(c).over(w)).otherwise(
        cut.value_of([None if r is None else r[c] for r in ends], kinds[c]))
    first = (F.row_number().over(w) == 1) & cut.value_of([r is None for r in ends], "boolean")
    return (cut.dealt().select("*", before(key).alias("_k"), before(value).alias("_v"), first.alias("_none"))
            .withColumn(out, F.when(~F.col("_none") & F.col("_k").eqNullSafe(F.col(key)), F.col("_v")))
            .select(*df.columns, out))


def child_counts(children: DataFrame, parent: str, counted: str, out: str) -> DataFrame:
    """Per parent id: number of children with a non-NULL ``counted``."""
    return children.groupBy(parent).agg(F.count(counted).alias(out))


def rounded_growth(current: Column, previous: Column, digits: int = 2) -> Column:
    return F.round(current - previous, digits)
