"""Oracle SQL (DuckDB) for each registered query key.

Each text is the plain, unoptimised statement of the question over the
catalogue CTEs (see :mod:`marquee.oracle.catalogue_sql`): windows partitioned
as asked, no pre-aggregation. Spark's optimised forms must equal them.
Means of ratings use exact decimals, like :func:`marquee.functions.exprs.mean_rating`.
"""

from __future__ import annotations

from marquee.oracle.catalogue_sql import with_catalogue


def MEAN(c: str = '"averageRating"') -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(12,6))) AS DOUBLE) / COUNT({c})"


def INT_MEAN(c: str) -> str:
    return f"CAST(SUM({c}) AS DOUBLE) / COUNT({c})"


def STR(c: str) -> str:
    return f"COALESCE(array_to_string({c}, ', '), '')"


DIRECTORS = ("d AS (SELECT c.tconst, unnest(c.directors) AS director FROM crew c "
             "WHERE c.directors IS NOT NULL)")

BODIES: dict[str, str] = {}

BODIES["recent_top_rated"] = f"""
SELECT b.tconst, b."primaryTitle", b."startYear", {STR('b.genres')} AS genres,
       r."averageRating", r."numVotes"
FROM basics b JOIN ratings r ON b.tconst = r.tconst
WHERE b."titleType" = 'movie' AND r."numVotes" >= 5000 AND b."startYear" > 2000
ORDER BY r."averageRating" DESC, r."numVotes" DESC, b.tconst LIMIT 10"""

BODIES["actors_in_acclaimed"] = """
SELECT p.nconst, n."primaryName", COUNT(DISTINCT p.tconst) AS movies_starred_in
FROM principals p JOIN name n ON p.nconst = n.nconst
WHERE p.category IN ('actor', 'actress') AND len(n."knownForTitles") >= 3
  AND p.tconst IN (SELECT b.tconst FROM basics b JOIN ratings r ON b.tconst = r.tconst
                   WHERE b."titleType" = 'movie' AND r."averageRating" > 8.2)
GROUP BY p.nconst, n."primaryName\""""

BODIES["genre_popularity"] = f"""
SELECT genre, {MEAN()} AS avg_rating, {INT_MEAN('"numVotes"')} AS avg_votes
FROM (SELECT unnest(b.genres) AS genre, r."averageRating", r."numVotes"
      FROM basics b JOIN ratings r ON b.tconst = r.tconst) g
GROUP BY genre"""

BODIES["runtime_by_frequent_type"] = f"""
SELECT "titleType", {INT_MEAN('"runtimeMinutes"')} AS avg_runtime
FROM basics WHERE "titleType" IS NOT NULL
GROUP BY "titleType" HAVING COUNT(*) >= 2000"""

BODIES["rank_in_genre"] = """
SELECT tconst, "primaryTitle", genre, "averageRating",
       rank() OVER (PARTITION BY genre ORDER BY "averageRating" DESC) AS rank_within_genre
FROM (SELECT b.tconst, b."primaryTitle", unnest(b.genres) AS genre, r."averageRating"
      FROM basics b JOIN ratings r ON b.tconst = r.tconst WHERE r."numVotes" > 100) x"""

_RUNNING = """
SELECT s."primaryTitle" AS series_title, {extra}e."seasonNumber", e."episodeNumber", r."averageRating",
       CAST(SUM(CAST(r."averageRating" AS DECIMAL(12,6))) OVER w AS DOUBLE)
         / COUNT(r."averageRating") OVER w AS cumulative_avg_rating
FROM basics t JOIN ratings r ON t.tconst = r.tconst
  JOIN episode e ON t.tconst = e.tconst
  JOIN basics s ON e."parentTconst" = s.tconst
WHERE t."titleType" = 'tvEpisode'
WINDOW w AS (PARTITION BY {key} ORDER BY e."seasonNumber" ASC NULLS FIRST,
                                         e."episodeNumber" ASC NULLS FIRST)"""
BODIES["series_running_mean"] = _RUNNING.format(extra="", key='s."primaryTitle"')
BODIES["series_running_mean_by_parent"] = _RUNNING.format(
    extra='e."parentTconst", ', key='e."parentTconst"')

BODIES["titles_in_language"] = """
SELECT "titleId", title FROM akas WHERE language = 'uk'"""

BODIES["long_film_rank"] = """
SELECT b."primaryTitle", b."runtimeMinutes", r."averageRating",
       dense_rank() OVER (ORDER BY r."averageRating" DESC) AS rank_among_long
FROM basics b JOIN ratings r ON b.tconst = r.tconst
WHERE b."titleType" = 'movie' AND b."runtimeMinutes" > 120"""

BODIES["acclaimed_popular"] = """
SELECT r.tconst, b."primaryTitle", r."averageRating", r."numVotes"
FROM ratings r JOIN basics b ON r.tconst = b.tconst
WHERE r."averageRating" > 8 AND r."numVotes" > 10000 AND b."titleType" = 'movie'"""

BODIES["genre_mean_rating"] = f"""
SELECT genre, COUNT(*) AS "count", {MEAN()} AS avg_rating
FROM (SELECT unnest(b.genres) AS genre, r."averageRating"
      FROM basics b JOIN ratings r ON b.tconst = r.tconst WHERE b."titleType" = 'movie') g
GROUP BY genre"""

BODIES["busiest_actors"] = """
WITH top AS (SELECT nconst, COUNT(*) AS film_count FROM principals WHERE category = 'actor'
             GROUP BY nconst HAVING COUNT(*) >= 10
             ORDER BY film_count DESC, nconst LIMIT 3)
SELECT n."primaryName", t.film_count FROM top t JOIN name n ON t.nconst = n.nconst"""

BODIES["actors_in_hits"] = """
WITH top AS (SELECT p.nconst, COUNT(*) AS high_rating_appearances FROM principals p
             WHERE p.category = 'actor'
               AND p.tconst IN (SELECT tconst FROM ratings
                                WHERE "averageRating" > 8.0 AND "numVotes" > 1000)
             GROUP BY p.nconst ORDER BY high_rating_appearances DESC, p.nconst LIMIT 10)
SELECT n."primaryName", t.high_rating_appearances FROM top t JOIN name n ON t.nconst = n.nconst"""

BODIES["localized_genre_pair"] = f"""
SELECT b.tconst, b."primaryTitle", u."ukrainianTitle", b."titleType", {STR('b.genres')} AS genres,
       r."averageRating", r."numVotes"
FROM basics b
  JOIN (SELECT DISTINCT "titleId", title AS "ukrainianTitle" FROM akas
        WHERE region = 'UA' AND "isOriginalTitle" = false) u ON b.tconst = u."titleId"
  JOIN ratings r ON b.tconst = r.tconst
WHERE list_contains(b.genres, 'Romance') AND list_contains(b.genres, 'Comedy')
  AND r."averageRating" >= 7 AND r."numVotes" >= 1000"""

BODIES["games_per_director"] = f"""
WITH {DIRECTORS}
SELECT n."primaryName", COUNT(*) AS num_video_games
FROM d JOIN basics b ON d.tconst = b.tconst JOIN name n ON d.director = n.nconst
WHERE b."titleType" = 'videoGame'
GROUP BY n."primaryName\""""

BODIES["titles_of_person"] = """
WITH who AS (SELECT min(nconst) AS nconst FROM name WHERE "primaryName" = 'small ring'),
t AS (SELECT DISTINCT c.tconst FROM crew c, who
      WHERE list_contains(c.directors, who.nconst) OR list_contains(c.writers, who.nconst))
SELECT b."primaryTitle", b."titleType", b."startYear", r."averageRating", r."numVotes"
FROM t JOIN basics b ON t.tconst = b.tconst JOIN ratings r ON t.tconst = r.tconst
WHERE r."averageRating" >= 6.5 AND r."numVotes" >= 200"""

BODIES["top3_series_per_region"] = """
SELECT region, "primaryTitle", "averageRating", "numVotes" FROM (
  SELECT a.region, b."primaryTitle", r."averageRating", r."numVotes",
         row_number() OVER (PARTITION BY a.region ORDER BY r."averageRating" DESC,
                            r."numVotes" DESC, b."primaryTitle", b.tconst) AS rn
  FROM basics b JOIN ratings r ON b.tconst = r.tconst JOIN akas a ON b.tconst = a."titleId"
  WHERE b."titleType" = 'tvSeries' AND r."averageRating" >= 7 AND r."numVotes" >= 1000
    AND a.region IS NOT NULL) x
WHERE rn <= 3"""

BODIES["longest_per_genre"] = """
SELECT genre, "primaryTitle", "runtimeMinutes" FROM (
  SELECT genre, "primaryTitle", "runtimeMinutes",
         row_number() OVER (PARTITION BY genre ORDER BY "runtimeMinutes" DESC, tconst) AS rn
  FROM (SELECT tconst, "primaryTitle", "runtimeMinutes", unnest(genres) AS genre FROM basics
        WHERE "titleType" = 'movie' AND "runtimeMinutes" IS NOT NULL AND genres IS NOT NULL) e) x
WHERE rn = 1"""

BODIES["episodes_per_title"] = """
SELECT b."primaryTitle", COUNT(e."episodeNumber") AS num_episodes, r."averageRating"
FROM basics b LEFT JOIN episode e ON e."parentTconst" = b.tconst
  JOIN ratings r ON b.tconst = r.tconst
GROUP BY b.tconst, b."primaryTitle", r."averageRating\""""

BODIES["dated_high_rated"] = """
SELECT b.tconst, b."primaryTitle", b."startYear", r."averageRating", r."numVotes"
FROM basics b JOIN ratings r ON b.tconst = r.tconst
WHERE b."titleType" = 'movie' AND b."startYear" IS NOT NULL AND r."averageRating" > 7.0"""

BODIES["dated_high_rated_in_language"] = BODIES["dated_high_rated"] + """
  AND b.tconst IN (SELECT "titleId" FROM akas WHERE language = 'en')"""

_BEST_DECADE = f"""
WITH {DIRECTORS},
s AS (SELECT d.director, CAST(FLOOR(b."startYear" / 10) * 10 AS INTEGER) AS decade,
             {MEAN('r."averageRating"')} AS avg_rating, COUNT(*) AS movie_count
      FROM basics b JOIN ratings r ON b.tconst = r.tconst JOIN d ON b.tconst = d.tconst
      WHERE b."titleType" = 'movie' AND b."startYear" IS NOT NULL
      GROUP BY d.director, decade),
k AS (SELECT * FROM s WHERE {{keep}}),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY director
                                                     ORDER BY avg_rating DESC, decade) AS rn
                        FROM k) WHERE rn = 1)
SELECT n."primaryName", best.director, best.decade, best.avg_rating, best.movie_count
FROM best LEFT JOIN name n ON best.director = n.nconst"""
BODIES["best_decade"] = _BEST_DECADE.format(keep="TRUE")
BODIES["best_decade_multi"] = _BEST_DECADE.format(
    keep="director IN (SELECT director FROM s GROUP BY director HAVING COUNT(*) >= 2)")

BODIES["genre_directors"] = f"""
WITH {DIRECTORS}
SELECT s.director, s.film_count, s.avg_rating, n."primaryName" FROM (
  SELECT d.director, COUNT(b.tconst) AS film_count, {MEAN('r."averageRating"')} AS avg_rating
  FROM basics b JOIN ratings r ON b.tconst = r.tconst JOIN d ON b.tconst = d.tconst
  WHERE list_contains(b.genres, 'Thriller') AND b."startYear" IS NOT NULL
  GROUP BY d.director
  HAVING COUNT(b.tconst) >= 2 AND {MEAN('r."averageRating"')} >= 7.0) s
LEFT JOIN name n ON s.director = n.nconst"""

_DOCS = """
SELECT b.tconst, b."primaryTitle", r."averageRating", r."numVotes"
FROM basics b JOIN ratings r ON b.tconst = r.tconst
WHERE b."titleType" = 'movie' AND b.genres IS NOT NULL
  AND list_contains(b.genres, 'Documentary') AND r."averageRating" > 7.5"""
BODIES["high_rated_documentaries"] = _DOCS
BODIES["documentaries_sorted"] = _DOCS + "\nORDER BY r.\"averageRating\" DESC, b.tconst"

_DUAL = """
SELECT n.nconst, n."primaryName" FROM name n
WHERE n.nconst IN (SELECT nconst FROM principals WHERE category IN ('actor', 'actress'))
  AND n.nconst IN (SELECT unnest(directors) FROM crew WHERE directors IS NOT NULL)
  AND n."primaryName" IS NOT NULL
  AND regexp_full_match(n."primaryName", '^[A-Za-z .''-]+$')"""
BODIES["actor_directors"] = _DUAL
BODIES["actor_directors_sorted"] = _DUAL + "\nORDER BY n.\"primaryName\", n.nconst"

_VERSATILE = f"""
WITH {DIRECTORS},
s AS (SELECT x.director, COUNT(DISTINCT x.genre) AS genre_count,
             {MEAN('x."averageRating"')} AS avg_rating
      FROM (SELECT d.director, unnest(b.genres) AS genre, r."averageRating"
            FROM basics b JOIN ratings r ON b.tconst = r.tconst JOIN d ON b.tconst = d.tconst
            WHERE b."titleType" = '{{kind}}' AND b.genres IS NOT NULL) x
      GROUP BY x.director
      HAVING COUNT(DISTINCT x.genre) >= 3 AND {MEAN('x."averageRating"')} > 7.5)
"""
BODIES["versatile_directors"] = _VERSATILE.format(kind="movie") + """
SELECT n."primaryName", s.genre_count, s.avg_rating FROM s LEFT JOIN name n ON s.director = n.nconst"""
BODIES["versatile_game_directors"] = _VERSATILE.format(kind="videoGame") + """
SELECT s.director, s.genre_count, s.avg_rating FROM s"""

BODIES["title_keyword"] = """
SELECT b."originalTitle", r."averageRating", r."numVotes", b."startYear"
FROM basics b JOIN ratings r ON b.tconst = r.tconst
WHERE b."titleType" IN ('videoGame', 'tvEpisode')
  AND (contains(b."primaryTitle", 'BUILDING') OR contains(b."originalTitle", 'BUILDING'))
  AND r."averageRating" >= 7.5 AND r."numVotes" >= 20"""

BODIES["recent_genre_counts"] = """
WITH g AS (SELECT unnest(genres) AS genre, "primaryTitle" FROM basics
           WHERE "titleType" = 'videoGame' AND "startYear" >= 2020),
pt AS (SELECT genre, "primaryTitle", COUNT(*) AS c FROM g GROUP BY genre, "primaryTitle"),
m AS (SELECT genre, "primaryTitle" AS "mostFrequentTitle" FROM (
        SELECT *, row_number() OVER (PARTITION BY genre ORDER BY c DESC, "primaryTitle") AS rn
        FROM pt) WHERE rn = 1),
t AS (SELECT genre, SUM(c) AS cnt FROM pt GROUP BY genre)
SELECT t.genre, CAST(t.cnt AS BIGINT) AS "count", m."mostFrequentTitle"
FROM t LEFT JOIN m ON t.genre = m.genre
ORDER BY t.cnt DESC, t.genre LIMIT 20"""

BODIES["recent_popular_games"] = """
SELECT b."primaryTitle", b."startYear", r."averageRating", r."numVotes"
FROM basics b JOIN ratings r ON b.tconst = r.tconst
WHERE b."titleType" = 'videoGame' AND b."startYear" >= 2015
  AND r."averageRating" >= 7.5 AND r."numVotes" >= 10000"""

BODIES["most_localized"] = """
SELECT b."primaryTitle", COUNT(DISTINCT a.region) AS localization_count
FROM basics b JOIN akas a ON b.tconst = a."titleId"
WHERE b."titleType" = 'videoGame' AND a.language <> 'und'
GROUP BY b."primaryTitle\""""

BODIES["rating_growth"] = """
SELECT "primaryTitle", "startYear", "averageRating", "numVotes", rating_growth FROM (
  SELECT b."primaryTitle", b."startYear", r."averageRating", r."numVotes",
         ROUND(r."averageRating" - lag(r."averageRating") OVER (
               PARTITION BY b."primaryTitle" ORDER BY b."startYear" ASC NULLS FIRST, b.tconst), 2)
           AS rating_growth
  FROM basics b JOIN ratings r ON b.tconst = r.tconst WHERE b."titleType" = 'videoGame') x
WHERE rating_growth > 0 AND "numVotes" >= 500"""

BODIES["actors_in_best_episodes"] = f"""
WITH e AS (SELECT b.tconst, b."startYear", r."averageRating"
           FROM basics b JOIN ratings r ON b.tconst = r.tconst
           WHERE b."titleType" = 'tvEpisode'),
top AS (SELECT * FROM (SELECT *, dense_rank() OVER (PARTITION BY "startYear"
                                                    ORDER BY "averageRating" DESC) AS dr
                       FROM e) WHERE dr = 1)
SELECT n."primaryName", top."startYear", COUNT(p.nconst) AS "roleCount",
       {MEAN('top."averageRating"')} AS "avgRating"
FROM top JOIN principals p ON top.tconst = p.tconst JOIN name n ON p.nconst = n.nconst
WHERE p.category = 'actor'
GROUP BY n."primaryName", top."startYear\""""

_BY_REGION = f"""
WITH x AS (SELECT a.region, b.tconst, unnest(b.genres) AS genre, r."averageRating"
           FROM basics b JOIN ratings r ON b.tconst = r.tconst JOIN akas a ON b.tconst = a."titleId"
           WHERE b."titleType" = 'movie' AND b.genres IS NOT NULL AND a.region IS NOT NULL
             AND {{votes}}),
s AS (SELECT region, genre, COUNT(DISTINCT tconst) AS title_count,
             {MEAN()} AS avg_rating
      FROM x WHERE {{genre}} GROUP BY region, genre)
SELECT region, genre, title_count, avg_rating,
       dense_rank() OVER (PARTITION BY region ORDER BY title_count DESC) AS "rank"
FROM s"""
BODIES["genres_by_region"] = _BY_REGION.format(votes="TRUE", genre="TRUE")
BODIES["genres_by_region_min_votes"] = _BY_REGION.format(
    votes='r."numVotes" >= 1000', genre="genre IS NOT NULL")

_TREND_BASE = f"""
WITH x AS (SELECT b."startYear", unnest(b.genres) AS genre, r."averageRating", r."numVotes"
           FROM basics b JOIN ratings r ON b.tconst = r.tconst
           WHERE b."titleType" = 'movie' AND b."startYear" IS NOT NULL AND b.genres IS NOT NULL
             AND len(b.genres) > 0 AND r."averageRating" IS NOT NULL AND {{votes}}),
s AS (SELECT "startYear", genre, COUNT(*) AS movie_count, {MEAN()} AS avg_rating,
             {INT_MEAN('"numVotes"')} AS avg_votes
      FROM x GROUP BY "startYear", genre)"""
_TREND = _TREND_BASE + """
SELECT "startYear", genre, movie_count, avg_rating, avg_votes,
       dense_rank() OVER (PARTITION BY "startYear" ORDER BY movie_count DESC) AS "rank"
FROM s"""
BODIES["genre_trend_by_year"] = _TREND.format(votes="TRUE")
BODIES["genre_trend_min_votes"] = _TREND.format(votes='r."numVotes" >= 1000')
BODIES["trend_top_genres"] = _TREND_BASE.format(votes="TRUE") + """,
tot AS (SELECT genre, SUM(movie_count) AS total FROM s GROUP BY genre
        ORDER BY total DESC, genre LIMIT 20)
SELECT s."startYear", s.genre, s.movie_count FROM s WHERE s.genre IN (SELECT genre FROM tot)"""

_LEADERS = f"""
WITH d AS (SELECT c.tconst, unnest(c.directors) AS director_id FROM crew c
           WHERE c.directors IS NOT NULL),
x AS (SELECT n."primaryName" AS director, r."averageRating"
      FROM d JOIN basics b ON d.tconst = b.tconst JOIN ratings r ON d.tconst = r.tconst
        {{how}} JOIN name n ON d.director_id = n.nconst
      WHERE b."titleType" = 'movie' AND r."numVotes" >= 1000 AND r."averageRating" IS NOT NULL),
s AS (SELECT director, COUNT(*) AS movie_count, {MEAN()} AS avg_rating
      FROM x GROUP BY director HAVING COUNT(*) >= 10)
SELECT director, movie_count, avg_rating,
       dense_rank() OVER (ORDER BY avg_rating DESC) AS "rank", 'director' AS role
FROM s"""
BODIES["director_leaderboard"] = _LEADERS.format(how="")
BODIES["director_leaderboard_left"] = _LEADERS.format(how="LEFT")

BODIES["actors_by_genre"] = """
WITH t AS (SELECT b.tconst, unnest(b.genres) AS genre, r."averageRating"
           FROM basics b JOIN ratings r ON b.tconst = r.tconst
           WHERE b."titleType" = 'movie' AND b."startYear" IS NOT NULL
             AND r."averageRating" IS NOT NULL AND b.genres IS NOT NULL
             AND r."numVotes" >= 1000),
x AS (SELECT t.genre, n."primaryName", t."averageRating"
      FROM principals p JOIN t ON p.tconst = t.tconst JOIN name n ON p.nconst = n.nconst
      WHERE p.category IN ('actor', 'actress')),
tot AS (SELECT "primaryName" FROM x GROUP BY "primaryName" HAVING COUNT(*) >= 10),
s AS (SELECT genre, "primaryName", COUNT(*) AS high_rated_movie_count FROM x
      WHERE "averageRating" >= 7 AND "primaryName" IN (SELECT "primaryName" FROM tot)
      GROUP BY genre, "primaryName")
SELECT genre, "primaryName", high_rated_movie_count,
       dense_rank() OVER (PARTITION BY genre ORDER BY high_rated_movie_count DESC) AS "rank"
FROM s"""

_COMBOS = f"""
SELECT array_to_string(list_sort(b.genres), ', ') AS genre_combo, COUNT(*) AS movie_count,
       {MEAN('r."averageRating"')} AS avg_rating, MAX(b."startYear") AS latest_year
FROM basics b JOIN ratings r ON b.tconst = r.tconst
WHERE b."titleType" = 'movie' AND b.genres IS NOT NULL AND len(b.genres) > 1
  AND r."averageRating" IS NOT NULL AND {{votes}}
GROUP BY genre_combo"""
BODIES["genre_combinations"] = _COMBOS.format(votes="TRUE")
BODIES["genre_combinations_min_votes"] = _COMBOS.format(votes='r."numVotes" >= 1000')

BODIES["top5_directors_per_genre"] = f"""
WITH m AS (SELECT b.tconst, b.genres, r."averageRating"
           FROM basics b JOIN ratings r ON b.tconst = r.tconst
           WHERE b."titleType" = 'movie' AND b.genres IS NOT NULL AND r."numVotes" >= 1000),
x AS (SELECT unnest(m.genres) AS genre, n."primaryName" AS director_name, m."averageRating"
      FROM m JOIN principals p ON m.tconst = p.tconst JOIN name n ON p.nconst = n.nconst
      WHERE p.category = 'director'),
s AS (SELECT genre, director_name, {MEAN()} AS avg_rating, COUNT(*) AS movie_count
      FROM x GROUP BY genre, director_name HAVING COUNT(*) >= 3)
SELECT * FROM (SELECT genre, director_name, avg_rating, movie_count,
                      row_number() OVER (PARTITION BY genre ORDER BY avg_rating DESC,
                                         movie_count DESC, director_name) AS "rank"
               FROM s) WHERE "rank" <= 5"""


def oracle_queries() -> dict[str, str]:
    stored = {f"{k}_stored": BODIES[k] for k in ("acclaimed_popular", "genre_mean_rating", "series_running_mean",
                                                 "actors_in_acclaimed")}
    return {k: with_catalogue(v) for k, v in (BODIES | stored).items()}
