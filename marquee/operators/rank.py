"""Ranking operators that stay parallel when groups are few or hot.

A window ``rank() OVER (PARTITION BY g ORDER BY v)`` sends every row of a
group to one task; with ten genres that is ten tasks for the whole table, and
an unpartitioned window is a single task. Two ways around it:

* ``ranked_in_order`` moves the rows once, into ranges along (group, value),
  ranks inside a range and adds what earlier ranges hold: for a result that
  is wanted in that order, of any number of distinct values;
* ``rank_within`` ranks a *value table* (one row per distinct (group, value)
  with its row count, a partial aggregate) and joins it back: for aggregates
  with few distinct values.

Top-k per group uses ``row_number() <= k``, which Spark plans as a partial
``WindowGroupLimit`` before the shuffle, so at most k rows per group leave
each map task whatever the group size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.operators.agg import materialize
from marquee.operators.prefix import null_safe_join, prefix_sums
from marquee.operators.ranges import RANGE, Ranges

Order = Sequence[Column]


def _ordered(value: str, descending: bool) -> Column:
    # Spark's defaults: ASC puts NULLs first, DESC puts them last.
    return F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_first()


def rank_within(df: DataFrame, groups: Sequence[str], value: str, out: str, *,
                dense: bool = False, descending: bool = True) -> DataFrame:
    """Add ``out`` = (dense_)rank of ``value`` within ``groups``.

    Equal to ``(dense_)rank().over(partitionBy(groups).orderBy(value))``. The
    (groups, value, count) table is built with a partial aggregate; the rank is
    1 + the rows (dense: values) before, a prefix sum over range blocks, and is
    joined back by group and value.
    """
    counts = df.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_n"))
    before = prefix_sums(counts, groups, [_ordered(value, descending)],
                         {"_before": F.lit(1) if dense else F.col("_n")}, inclusive=False)
    table = before.select(*groups, value, (F.col("_before") + 1).cast("bigint").alias(out))
    return null_safe_join(df, table, [*groups, value])


def ranked_in_order(df: DataFrame, group: str, value: str, row_id: str, out: str) -> DataFrame:
    """``df`` with ``out`` = rank (with gaps) of ``value`` within ``group``,
    greatest first and NULL last, in the order of group, rank and ``row_id``.

    The rows move once: ranges are cut along (group, value, id), so ties may
    be split as well. A row's rank is the number of its group's rows with a
    greater value in its range, and in the ranges before it, plus one.
    """
    rows = materialize(df.withColumn("_none", F.col(value).isNull()).withColumn("_down", -F.col(value)))
    cut = Ranges(rows, [group, "_none", "_down", row_id], keys=1)
    before = cut.carried({"rows": (1, F.lit(1)), "peers": (3, F.lit(1))})
    earlier = cut.value_of([r["rows"] for r in before], "bigint")
    w = Window.partitionBy(RANGE, group).orderBy("_none", "_down", row_id)
    here = F.struct("_none", "_down")
    change = F.when(F.coalesce(F.lag(here).over(w) != here, F.lit(True)), F.row_number().over(w))
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rank = (F.when(cut.begins_inside(3), earlier - cut.value_of([r["peers"] for r in before], "bigint") + 1)
            .when(cut.begins_inside(1), F.max("_first").over(upto) + earlier).otherwise(F.max("_first").over(upto)))
    return (cut.dealt().withColumn("_first", change).withColumn(out, rank.cast("bigint"))
            .select(*df.columns, out))


def global_dense_rank(df: DataFrame, value: str, out: str, *,
                      descending: bool = True) -> DataFrame:
    """``dense_rank()`` over the whole frame: a rank in one group, without a
    single-task window."""
    return rank_within(df, [], value, out, dense=True, descending=descending)


def top_k_per_group(df: DataFrame, groups: Sequence[str], order: Order, k: int,
                    rank_col: str | None = None) -> DataFrame:
    """Rows with ``row_number() <= k`` per group (partial limit before shuffle)."""
    w = Window.partitionBy(*groups).orderBy(*order)
    tmp = rank_col or "_rn"
    out = df.withColumn(tmp, F.row_number().over(w)).where(F.col(tmp) <= k)
    if rank_col:
        return out.withColumn(rank_col, F.col(rank_col).cast("bigint"))
    return out.drop(tmp)


def best_per_group(df: DataFrame, groups: Sequence[str], order: Order) -> DataFrame:
    """The first row of each group under ``order`` (ties broken by ``order``)."""
    return top_k_per_group(df, groups, order, 1)


def top_k(df: DataFrame, order: Order, k: int) -> DataFrame:
    """Global top-k: ``TakeOrderedAndProject`` keeps k rows per task."""
    return df.orderBy(*order).limit(k)
