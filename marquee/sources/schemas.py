"""The seven raw table layouts of the public title/name dumps.

Fixed values: column names, order and raw types must equal those of the
published tab-separated files, so they are stated here as plain text.
``isAdult`` is read as a string and cast after the read, because the dumps
hold 0/1 there and the CSV boolean parser accepts only true/false.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, D = T.StringType(), T.IntegerType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# --- fixed values: raw layouts of the seven dump files ---------------------
RAW_SCHEMAS: dict[str, T.StructType] = {
    "akas": _struct(
        ("titleId", S), ("ordering", I), ("title", S), ("region", S),
        ("language", S), ("types", S), ("attributes", S), ("isOriginalTitle", S)),
    "basics": _struct(
        ("tconst", S), ("titleType", S), ("primaryTitle", S), ("originalTitle", S),
        ("isAdult", S), ("startYear", I), ("endYear", I), ("runtimeMinutes", I),
        ("genres", S)),
    "crew": _struct(("tconst", S), ("directors", S), ("writers", S)),
    "episode": _struct(
        ("tconst", S), ("parentTconst", S), ("seasonNumber", I), ("episodeNumber", I)),
    "principals": _struct(
        ("tconst", S), ("ordering", I), ("nconst", S), ("category", S), ("job", S),
        ("characters", S)),
    "ratings": _struct(("tconst", S), ("averageRating", D), ("numVotes", I)),
    "name": _struct(
        ("nconst", S), ("primaryName", S), ("birthYear", I), ("deathYear", I),
        ("primaryProfession", S), ("knownForTitles", S)),
}

# File stem of each table in the dumps.
FILE_STEMS: dict[str, str] = {
    "akas": "title.akas",
    "basics": "title.basics",
    "crew": "title.crew",
    "episode": "title.episode",
    "principals": "title.principals",
    "ratings": "title.ratings",
    "name": "name.basics",
}

# Comma-separated list columns, turned into array<string> after the read.
LIST_COLUMNS: dict[str, tuple[str, ...]] = {
    "akas": ("types", "attributes"),
    "basics": ("genres",),
    "crew": ("directors", "writers"),
    "episode": (),
    "principals": (),
    "ratings": (),
    "name": ("primaryProfession", "knownForTitles"),
}

# 0/1 (or true/false) flag columns, turned into boolean after the read.
FLAG_COLUMNS: dict[str, tuple[str, ...]] = {
    "akas": ("isOriginalTitle",),
    "basics": ("isAdult",),
}

NULL_TOKEN = "\\N"
LIST_SEPARATOR = ","


def shaped_schema(table: str) -> T.StructType:
    """Schema of a table after list and flag columns are shaped."""
    out = []
    for f in RAW_SCHEMAS[table].fields:
        if f.name in LIST_COLUMNS[table]:
            out.append(T.StructField(f.name, T.ArrayType(S, True), True))
        elif f.name in FLAG_COLUMNS.get(table, ()):
            out.append(T.StructField(f.name, T.BooleanType(), True))
        else:
            out.append(f)
    return T.StructType(out)
