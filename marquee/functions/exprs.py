"""Column expressions shared by the queries (all JVM-side built-ins).

Means of ratings are sums of decimals divided once: a decimal sum is exact
whatever the summation order. A plain ``avg`` of doubles depends on the order
partial sums are merged in, so two engines (or two runs) can disagree in the
last bit. Six decimals are kept, far more than a rating has.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RATING = "averageRating"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact(c: str | Column = RATING) -> Column:
    """A rating as an exact decimal."""
    return col(c).cast("decimal(12,6)")


def mean_from_sum(total: Column, n: Column) -> Column:
    """Mean from an exact sum and a count (NULL when n = 0)."""
    return F.try_divide(total.cast("double"), n)


def mean_rating(c: str | Column = RATING) -> Column:
    """Aggregate: exact mean of a rating column."""
    return mean_from_sum(F.sum(exact(c)), F.count(col(c)))


def int_mean(c: str | Column) -> Column:
    """Aggregate: mean of an integer column (the sum is exact)."""
    return F.try_divide(F.sum(col(c).cast("bigint")).cast("double"), F.count(col(c)))


def stringify(c: str | Column, sep: str = ", ") -> Column:
    """An array as one string: NULL elements skipped, a NULL array gives ''."""
    return F.concat_ws(sep, col(c))


def decade(year: str | Column) -> Column:
    return (F.floor(col(year) / 10) * 10).cast("int")


def combo_key(arr: str | Column, sep: str = ", ") -> Column:
    """Order-free key of a list: its sorted elements joined."""
    return F.concat_ws(sep, F.array_sort(col(arr)))


def has_all(arr: str | Column, *values: str) -> Column:
    out = None
    for v in values:
        term = F.array_contains(col(arr), v)
        out = term if out is None else (out & term)
    return out
