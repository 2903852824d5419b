"""Operators over the title-person bridge (credits and crew lists)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def credits_in(principals: DataFrame, categories: Sequence[str]) -> DataFrame:
    """(tconst, nconst) credit rows whose category is one of ``categories``."""
    return (principals.where(F.col("category").isin(*categories))
            .select("tconst", "nconst"))


def directors_of(crew: DataFrame) -> DataFrame:
    """(tconst, director) of the long crew table (tconst, nconst, role)."""
    return (crew.where(F.col("role") == "director")
            .select("tconst", F.col("nconst").alias("director")))


def person_ids(name: DataFrame, person: str) -> DataFrame:
    """The id of the person called ``person``: one row or none.

    Namesakes share a name; the lowest id is taken so the choice is
    repeatable. The global aggregate yields at most one row, a proven bound,
    so it can always be broadcast.
    """
    one = (name.where(F.col("primaryName") == person)
           .agg(F.min("nconst").alias("nconst"))
           .where(F.col("nconst").isNotNull()))
    return F.broadcast(one)
