"""Connected components of an edge table by alternating star steps.

Large-star links every larger neighbour of a node to the smallest node it
sees, small-star does so with the smaller ones; the two keep the components
and end in stars after a logarithmic number of rounds. A node with very many
neighbours is only ever one side of a join that AQE can split: its minimum is
a partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import drop, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if large:
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        out = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        out = down.join(low, "a").select("b", "m").union(low.select("a", "m")).toDF("a", "b")
    return out.where("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                           F.sum(F.xxhash64("b", "a") % 1_000_003)).first())


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``: root is the component's
    smallest node. Self loops and null ends are ignored; no edges, no rows."""
    now = written(edges.select("a", "b").where("a <> b").distinct(), label)
    mark, last = _mark(now), None
    while mark != last:
        after = written(_star(_star(now, True), False), label)
        drop(edges.sparkSession, now.scratch)
        now, mark, last = after, _mark(after), mark
    return (now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .union(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())
