"""Running (prefix) sums along an order, split across range blocks.

``sum(x) OVER (PARTITION BY keys ORDER BY order ROWS UNBOUNDED PRECEDING)``
puts every row of a key in one task. Here the rows are range-partitioned on
(keys, order) into blocks of balanced size (checkpointed, so block ids are
fixed); each block sums locally with a
window on (keys, block), and each block adds the totals of the key's earlier
blocks, taken from a table with one row per (key, block). A key holding a
third of all rows is spread over many blocks, and no window sees more than
one block.

Ranks with gaps, dense ranks, running means and cumulative shares are all
prefix sums over a table that is unique in (keys, order).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.operators.agg import materialize
from marquee.session import shuffle_partitions


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL matches NULL (groups may be NULL)."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        term = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = term if cond is None else cond & term
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def range_blocks(df: DataFrame, spec: Sequence[Column]) -> DataFrame:
    """``df`` range-partitioned on ``spec`` with each row's block id ``_blk``.

    Range boundaries come from sampling, so two evaluations of the same plan
    may cut blocks differently. The rows are therefore checkpointed once with
    their block id as data, and every later use reads the same blocks.
    """
    ranged = (df.repartitionByRange(shuffle_partitions(df), *spec)
              .withColumn("_blk", F.spark_partition_id()))
    return materialize(ranged)


def prefix_sums(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                sums: dict[str, Column], *, inclusive: bool = True) -> DataFrame:
    """Add one running-sum column per ``sums`` entry (name -> summed expression).

    ``order`` holds sort expressions and must be total within ``keys`` (the
    table is unique in (keys, order)). ``inclusive=False`` sums the rows
    strictly before each row. Empty prefixes give 0. The same blocks are used
    at every size.
    """
    keys = list(keys)
    frame = (Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    spec = [F.col(k).asc_nulls_first() for k in keys] + list(order)
    ranged = range_blocks(df, spec)
    tmp = {name: f"_v_{name}" for name in sums}
    ranged = ranged.select("*", *[expr.alias(tmp[name]) for name, expr in sums.items()])
    inner = Window.partitionBy(*keys, "_blk").orderBy(*order).rowsBetween(*frame)
    local = ranged.select("*", *[F.coalesce(F.sum(tmp[n]).over(inner), F.lit(0)).alias(f"_l_{n}")
                                 for n in sums])
    totals = ranged.groupBy(*keys, "_blk").agg(*[F.sum(tmp[n]).alias(f"_t_{n}") for n in sums])
    before = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_blk", *[
        F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums])
    joined = null_safe_join(local, offsets, [*keys, "_blk"])
    return joined.select(
        *df.columns, *[(F.col(f"_o_{n}") + F.col(f"_l_{n}")).alias(n) for n in sums])
