"""Oracle SQL (DuckDB) for the ingest and sink round trips: the SQL of what
was written, since a faithful round trip returns exactly that."""

from __future__ import annotations

from marquee.oracle.catalogue_sql import tables_used, with_catalogue
from marquee.oracle.profile_sql import dataset_info
from marquee.oracle.queries_sql import BODIES, STR
from marquee.sources.schemas import FLAG_COLUMNS, LIST_COLUMNS, shaped_schema


def _q(c: str) -> str:
    return f'"{c}"'


def _shaped(table: str) -> str:
    cols = [STR(_q(c)) + f" AS {_q(c)}" if c in LIST_COLUMNS[table] else _q(c)
            for c in (f.name for f in shaped_schema(table).fields)]
    return with_catalogue(f"SELECT {', '.join(cols)} FROM {table}", {table})


def _raw_basics() -> str:
    cols = []
    for f in shaped_schema("basics").fields:
        c = f.name
        if c in LIST_COLUMNS["basics"]:
            cols.append(f"CASE WHEN {_q(c)} IS NULL THEN NULL "
                        f"ELSE array_to_string({_q(c)}, ',') END AS {_q(c)}")
        elif c in FLAG_COLUMNS["basics"]:
            cols.append(f"CASE WHEN {_q(c)} THEN '1' WHEN NOT {_q(c)} THEN '0' END AS {_q(c)}")
        else:
            cols.append(_q(c))
    return with_catalogue(f"SELECT {', '.join(cols)} FROM basics", {"basics"})


_UNTYPED = """
SELECT tconst, "parentTconst", {season} AS "seasonNumber",
       CAST("episodeNumber" AS VARCHAR) AS "episodeNumber"
FROM episode"""


# Titles whose field is broken, by the number in their id.
_BROKEN = {"startYear": (50, 1), "runtimeMinutes": (75, 2), "isAdult": (90, 3)}
_MALFORMED = " UNION ALL ".join(
    ["SELECT 'basics' AS table_name, CAST(NULL AS VARCHAR) AS column_name, COUNT(*) AS n_rows, "
     "CAST(0 AS BIGINT) AS n_malformed FROM basics"]
    + [f"SELECT 'basics', '{f.name}', COUNT(*), COUNT(*) FILTER ("
       + (f"CAST(substr(tconst, 3) AS BIGINT) % {_BROKEN[f.name][0]} = {_BROKEN[f.name][1]}"
          if f.name in _BROKEN else "FALSE") + ") FROM basics"
       for f in shaped_schema("basics").fields])


def oracle_ingest() -> dict[str, str]:
    out = {
        "scan_typed_tsv": _raw_basics(),
        "scan_untyped_tsv": with_catalogue(_UNTYPED.format(
            season="COALESCE(CAST(\"seasonNumber\" AS VARCHAR), '\\N')")),
        "clean_null_token": with_catalogue(_UNTYPED.format(
            season='CAST("seasonNumber" AS VARCHAR)')),
        "load_catalogue": dataset_info(),
        "export_csv_auto": with_catalogue(BODIES["rank_in_genre"]),
        "export_csv_n": with_catalogue(BODIES["best_decade"]),
        "export_csv_partitioned": with_catalogue(BODIES["genre_trend_by_year"]),
        "stringify_arrays": _shaped("basics"),
        "result_stats": with_catalogue(
            "SELECT 'rank_in_genre' AS title, COUNT(*) AS n_rows FROM ("
            + BODIES["rank_in_genre"] + ") q"),
        "result_first_rows": with_catalogue(
            "SELECT 'rank_in_genre' AS title, n_rows, CAST(place AS INTEGER) AS place, tconst, \"primaryTitle\", genre, "
            "\"averageRating\", rank_within_genre FROM (SELECT *, COUNT(*) OVER () AS n_rows, row_number() OVER "
            "(ORDER BY genre, rank_within_genre, tconst) AS place FROM (" + BODIES["rank_in_genre"] + ") q) "
            "WHERE place <= 10", tables_used(BODIES["rank_in_genre"])),
        "malformed_fields": with_catalogue(_MALFORMED, {"basics"}),
        "load_well_formed": with_catalogue(
            "SELECT * FROM ratings WHERE CAST(substr(tconst, 3) AS BIGINT) % 40 <> 5 "
            "AND CAST(substr(tconst, 3) AS BIGINT) % 60 <> 6", {"ratings"}),
        "export_single_file": with_catalogue(BODIES["top3_series_per_region"]),
    }
    for t in ("basics", "akas", "crew", "episode", "ratings", "principals", "name"):
        out[f"shape_{t}"] = _shaped(t)
    return out
