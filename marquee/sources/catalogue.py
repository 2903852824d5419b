"""The catalogue: seven lazy DataFrames, one per table.

Tables are built on first use, so a query that touches two tables never
lists or plans the other five.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TABLES = ("basics", "akas", "crew", "episode", "ratings", "principals", "name")
#: The crew lists in long form, for the questions; a catalogue whose crew is
#: derived from credits gives it without building lists.
LONG_CREW = "crew_people"


def unlisted(crew: DataFrame) -> DataFrame:
    """(tconst, nconst, role) of crew lists: role is director or writer."""
    def members(column: str, role: str):
        listed = F.transform(column, lambda p: F.struct(p.alias("nconst"), F.lit(role).alias("role")))
        return F.coalesce(listed, F.array().cast("array<struct<nconst:string,role:string>>"))
    person = F.explode(F.concat(members("directors", "director"), members("writers", "writer")))
    return crew.select("tconst", person.alias("_p")).select("tconst", "_p.nconst", "_p.role")


class Catalogue:
    def __init__(self, builders: dict[str, Callable[[], DataFrame] | DataFrame]):
        missing = set(TABLES) - set(builders)
        if missing:
            raise ValueError(f"catalogue lacks tables: {sorted(missing)}")
        self._builders = {LONG_CREW: lambda: unlisted(self["crew"]), **builders}
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._built:
            b = self._builders[table]
            self._built[table] = b if isinstance(b, DataFrame) else b()
        return self._built[table]

    def __getattr__(self, table: str) -> DataFrame:
        if table.startswith("_") or table not in (*TABLES, LONG_CREW):
            raise AttributeError(table)
        return self[table]

    def as_dict(self) -> dict[str, DataFrame]:
        return {t: self[t] for t in TABLES}
