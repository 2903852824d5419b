"""Rows dealt out once in ranges with fixed edges.

A running value over an order (a rank, a running mean, the value before) needs
each row's place among the rows of its key, and a key may hold a third of all
rows. Here a stored table is cut into ranges of balanced size along (key,
position). The edges are values, taken from a sample, so a row's range is a
function of the row: any job, and any task that runs again, finds the same one.

* a first pass reads the order's columns and aggregates one row for each range:
  what the key that goes on into the next range has there;
* from these rows (one for each range: a proven bound) the driver adds up what
  each range's first key had in the ranges before it;
* a second pass moves the rows once, straight to their range's partition,
  sorts it, and adds the carried value to a window inside the range.

There is no join back to the rows and no second sort, and the result is in
order across partitions, so it needs no sort of its own either.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.session import shuffle_partitions

#: Sampled rows for each range, on average; no range gets more than a few times its share.
SAMPLED = 40

RANGE = "_range"


class Ranges:
    """Ranges of ``rows`` (a stored table: it is read three times) along the
    columns ``order``, ascending with NULLs first; the first ``keys`` of them
    are the key. With ``whole_positions`` rows of one position stay together."""

    def __init__(self, rows: DataFrame, order: Sequence[str], keys: int):
        self.rows, self.order, self.keys = rows, list(order), keys
        self.spark = rows.sparkSession
        self.schema = T.StructType([rows.schema[c] for c in self.order])
        self.edges = self._edges(shuffle_partitions(rows))
        self.n = len(self.edges) + 1

    def _edges(self, ranges: int) -> list[Row]:
        """Values at which ranges begin, ascending and distinct."""
        if ranges < 2:
            return []
        whole = self.rows.count()  # of a stored table: its files say it
        wanted = SAMPLED * ranges
        some = self.rows.select(*self.order)
        if whole > 2 * wanted:
            some = some.sample(wanted / whole, seed=7)
        ordered = some.orderBy(F.struct(*self.order)).limit(4 * wanted).collect()
        step = max(1, len(ordered) // ranges)
        return list(dict.fromkeys(ordered[step::step]))[:ranges - 1]

    def _literal(self, edge: Row, n: int | None = None) -> Column:
        return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name)
                          for v, f in list(zip(edge, self.schema))[:n]])

    def number(self) -> Column:
        """A row's range, by a binary search among the edges."""
        if not self.edges:
            return F.lit(0)
        edges = F.array(*[self._literal(e) for e in self.edges])
        here = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])
        steps = [1 << k for k in range(len(self.edges).bit_length() - 1, -1, -1)]
        return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(
            (at + step <= len(self.edges)) & (F.get(edges, at + step - 1) <= here), at + step).otherwise(at))

    def _same_key(self, edge: Column, n: int) -> Column:
        same = F.lit(True)
        for f in list(self.schema)[:n]:
            same = same & F.col(f.name).eqNullSafe(edge[f.name])
        return same

    def tails(self, sums: dict[str, tuple[int, Column]]) -> list[dict[str, Any]]:
        """For each range the sums (name: (columns of the order, value)) over its
        rows that share so many leading columns with the next range's edge."""
        out: list[dict[str, Any]] = [{} for _ in range(self.n)]
        if not self.edges:
            return out
        after = F.get(F.array(*[self._literal(e) for e in self.edges]), F.col(RANGE))
        found = (self.rows.withColumn(RANGE, self.number()).where(F.col(RANGE) < len(self.edges))
                 .withColumn("_edge", after).where(self._same_key(F.col("_edge"), min(n for n, _ in sums.values())))
                 .groupBy(RANGE).agg(*[F.sum(F.when(self._same_key(F.col("_edge"), n), value)).alias(name)
                                       for name, (n, value) in sums.items()]))
        for row in found.collect():  # at most a row for each range
            out[row[RANGE]] = row.asDict()
        return out

    def carried(self, sums: dict[str, tuple[int, Column]], zero: Any = 0) -> list[dict[str, Any]]:
        """For each range and sum: the total over all earlier rows that share
        its leading columns with the range's lower edge."""
        tails = self.tails(sums)
        out: list[dict[str, Any]] = [dict.fromkeys(sums, zero)]
        for b, edge in enumerate(self.edges, 1):
            row = {}
            for name, (n, _) in sums.items():
                total = tails[b - 1].get(name) or zero
                if b > 1 and self.edges[b - 2][:n] == edge[:n]:  # the range before began inside the key, too
                    total = total + out[b - 1][name]
                row[name] = total
            out.append(row)
        return out

    def last(self, value: str) -> list[Any]:
        """For each range the (key..., value) of the last row before it, or None."""
        found = (self.rows.withColumn(RANGE, self.number()).groupBy(RANGE)
                 .agg(F.max_by(F.struct(*self.order[:self.keys], value), F.struct(*self.order)).alias("row")).collect())
        ends = {r[RANGE]: r["row"] for r in found}
        out, last = [], None
        for b in range(self.n):
            out.append(last)
            last = ends.get(b, last)
        return out

    def begins_inside(self, n: int) -> Column:
        """Whether a row shares its first ``n`` columns with its range's lower
        edge, so that earlier ranges may hold rows before it."""
        if not self.edges:
            return F.lit(False)
        edge = F.get(F.array(*[self._literal(e) for e in self.edges]), F.col(RANGE) - 1)
        return F.coalesce((F.col(RANGE) > 0) & self._same_key(edge, n), F.lit(False))

    def value_of(self, values: Sequence[Any], kind: str) -> Column:
        """The range's entry in a list with one for each range."""
        return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col(RANGE))

    def dealt(self) -> DataFrame:
        """The rows in their ranges' partitions (column ``_range``)."""
        return self.rows.withColumn(RANGE, self.number()).repartitionById(self.n, RANGE)
