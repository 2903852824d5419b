"""Oracle SQL (DuckDB) for the profiling keys, generated from the table layouts."""

from __future__ import annotations

from pyspark.sql import types as T

from marquee.oracle.catalogue_sql import with_catalogue
from marquee.oracle.queries_sql import INT_MEAN, MEAN
from marquee.sources.catalogue import TABLES
from marquee.sources.schemas import shaped_schema


def _cols(table: str, kinds: tuple[type, ...]) -> list[str]:
    return [f.name for f in shaped_schema(table).fields if isinstance(f.dataType, kinds)]


def _stats_block(table: str, column: str, stats: tuple[str, ...], with_table: bool) -> str:
    exprs = {
        "count": 'CAST(COUNT(x) AS DOUBLE)',
        "mean": "ROUND(AVG(x), 6)",
        "stddev": "ROUND(STDDEV_SAMP(x), 6)",
        "min": "MIN(x)",
        "max": "MAX(x)",
        "25%": "MIN(x) FILTER (WHERE share >= 0.25)",
        "50%": "MIN(x) FILTER (WHERE share >= 0.5)",
        "75%": "MIN(x) FILTER (WHERE share >= 0.75)",
    }
    names = ", ".join(f"'{s}'" for s in stats)
    vals = ", ".join(f"CAST({exprs[s]} AS DOUBLE)" for s in stats)
    lead = f"'{table}' AS table_name, " if with_table else ""
    return f"""
SELECT {lead}'{column}' AS column_name, unnest([{names}]) AS stat, unnest([{vals}]) AS value
FROM (SELECT x, cume_dist() OVER (ORDER BY x) AS share
      FROM (SELECT CAST("{column}" AS DOUBLE) AS x FROM {table} WHERE "{column}" IS NOT NULL) v) c"""


SUMMARY = ("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")
DESCRIBE = ("count", "mean", "stddev", "min", "max")


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(f"SELECT * FROM ({p})" for p in parts)


def dataset_info() -> str:
    parts = [f"SELECT '{t}' AS table_name, CAST({len(shaped_schema(t).fields)} AS INTEGER) "
             f"AS n_columns, COUNT(*) AS n_rows FROM {t}" for t in TABLES]
    return with_catalogue(_union(parts), set(TABLES))


def column_info() -> str:
    parts = [f"SELECT '{t}' AS table_name, CAST({i} AS INTEGER) AS position, '{f.name}' AS column_name, "
             f"'{f.dataType.simpleString()}' AS column_type, COUNT(\"{f.name}\") AS n_values FROM {t}"
             for t in TABLES for i, f in enumerate(shaped_schema(t).fields)]
    return with_catalogue(_union(parts), set(TABLES))


def preview_titles() -> str:
    cols = ", ".join(f"COALESCE(array_to_string(\"{f.name}\", ', '), '') AS \"{f.name}\""
                     if isinstance(f.dataType, T.ArrayType) else f'"{f.name}"'
                     for f in shaped_schema("basics").fields)
    return with_catalogue(f"SELECT {cols} FROM basics ORDER BY tconst LIMIT 5", {"basics"})


def numeric_summary() -> str:
    parts = [_stats_block(t, c, SUMMARY, True)
             for t in TABLES for c in _cols(t, (T.IntegerType, T.DoubleType))]
    return with_catalogue(_union(parts), set(TABLES))


def describe_columns() -> str:
    parts = [_stats_block("basics", c, DESCRIBE, False) for c in ("startYear", "runtimeMinutes")]
    return with_catalogue(_union(parts), {"basics"})


def categorical_distincts() -> str:
    parts = []
    for t in TABLES:
        for c in _cols(t, (T.StringType,)):
            parts.append(f"""
SELECT * FROM (
  SELECT '{t}' AS table_name, '{c}' AS column_name,
         COUNT(DISTINCT "{c}") + MAX(CASE WHEN "{c}" IS NULL THEN 1 ELSE 0 END) AS distinct_count,
         COALESCE(array_to_string(list_sort(list_distinct(list("{c}")))[1:5], ', '), '') AS sample
  FROM {t}) s WHERE distinct_count <= 20""")
    return with_catalogue(_union(parts), set(TABLES))


def runtime_rating_corr() -> str:
    return with_catalogue("""
SELECT ROUND(CASE WHEN stddev_pop(x) > 0 AND stddev_pop(y) > 0 THEN corr(x, y) END, 6)
         AS correlation
FROM (SELECT CAST(b."runtimeMinutes" AS INTEGER) AS x, CAST(r."averageRating" AS REAL) AS y
      FROM basics b JOIN ratings r ON b.tconst = r.tconst
      WHERE b."runtimeMinutes" IS NOT NULL AND r."averageRating" IS NOT NULL) t""")


def title_type_profile() -> str:
    return with_catalogue(f"""
SELECT "titleType", COUNT(*) AS "count",
       CASE WHEN "titleType" IS NULL THEN CAST(0 AS DOUBLE)
            ELSE COALESCE({INT_MEAN('"runtimeMinutes"')}, CAST(0 AS DOUBLE)) END AS average_runtime
FROM basics GROUP BY "titleType\"""")


def subset_means() -> str:
    return with_catalogue(f"""
SELECT {MEAN('r."averageRating"')} AS avg_rating, {INT_MEAN('r."numVotes"')} AS avg_votes
FROM basics b JOIN ratings r ON b.tconst = r.tconst WHERE b."titleType" = 'videoGame'""")


def oracle_profile() -> dict[str, str]:
    return {
        "dataset_info": dataset_info(),
        "column_info": column_info(),
        "preview_titles": preview_titles(),
        "numeric_summary": numeric_summary(),
        "describe_columns": describe_columns(),
        "categorical_distincts": categorical_distincts(),
        "runtime_rating_corr": runtime_rating_corr(),
        "title_type_profile": title_type_profile(),
        "subset_means": subset_means(),
    }
