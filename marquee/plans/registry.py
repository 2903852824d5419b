"""Registered questions: key -> function of a catalogue.

Keys follow the survey's inventory. Parameters are the question defaults
unless a binding is noted: the driver's tables make a few defaults select
nothing, so those keys bind a value that does select rows (noted inline).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marquee.fixed import VIDEO_GAME
from marquee.plans import ingest, people, profiling, regions, series, titles
from marquee.sources.catalogue import Catalogue
from marquee.sources.star import star_catalogue
from marquee.sources.store import stored

CatalogueQuery = Callable[[Catalogue], DataFrame]
QUERIES: dict[str, CatalogueQuery] = {}


def register(key: str):
    def deco(fn: CatalogueQuery) -> CatalogueQuery:
        if key in QUERIES:
            raise ValueError(f"duplicate key {key}")
        QUERIES[key] = fn
        return fn
    return deco


# --- titles ---------------------------------------------------------------
register("recent_top_rated")(lambda c: titles.recent_top_rated(c.basics, c.ratings))
register("genre_popularity")(lambda c: titles.genre_popularity(c.basics, c.ratings))
# Binding: 2000 rows (1000 keeps every type of the driver's tables).
register("runtime_by_frequent_type")(
    lambda c: titles.runtime_by_frequent_type(c.basics, min_rows=2000))
register("rank_in_genre")(lambda c: titles.rank_in_genre(c.basics, c.ratings))
register("titles_in_language")(lambda c: titles.titles_in_language(c.akas))
register("long_film_rank")(lambda c: titles.long_film_rank(c.basics, c.ratings))
register("acclaimed_popular")(lambda c: titles.acclaimed_popular(c.basics, c.ratings))
register("genre_mean_rating")(lambda c: titles.genre_mean_rating(c.basics, c.ratings))
register("dated_high_rated")(lambda c: titles.dated_high_rated(c.basics, c.ratings))
register("dated_high_rated_in_language")(
    lambda c: titles.dated_high_rated(c.basics, c.ratings, akas=c.akas, language="en"))
register("high_rated_documentaries")(
    lambda c: titles.high_rated_in_genre(c.basics, c.ratings))
register("documentaries_sorted")(
    lambda c: titles.high_rated_in_genre(c.basics, c.ratings, order_by_rating=True))
register("longest_per_genre")(lambda c: titles.longest_per_genre(c.basics))
register("genre_combinations")(lambda c: titles.genre_combinations(c.basics, c.ratings))
register("genre_combinations_min_votes")(
    lambda c: titles.genre_combinations(c.basics, c.ratings, min_votes=1000))
# Binding: needle 'BUILDING' (the driver's titles are market segments).
register("title_keyword")(
    lambda c: titles.title_keyword(c.basics, c.ratings, needle="BUILDING"))
register("recent_genre_counts")(lambda c: titles.recent_genre_counts(c.basics))
register("recent_popular_games")(lambda c: titles.recent_popular(c.basics, c.ratings))
register("localized_genre_pair")(
    lambda c: titles.localized_genre_pair(c.basics, c.akas, c.ratings))

# --- people ---------------------------------------------------------------
register("actors_in_acclaimed")(
    lambda c: people.actors_in_acclaimed(c.basics, c.ratings, c.principals, c.name))
register("busiest_actors")(lambda c: people.busiest_actors(c.principals, c.name))
register("actors_in_hits")(lambda c: people.actors_in_hits(c.principals, c.ratings, c.name))
register("games_per_director")(lambda c: people.games_per_director(c.basics, c.crew_people, c.name))
# Binding: a name with several namesakes in the driver's tables.
register("titles_of_person")(
    lambda c: people.titles_of_person(c.name, c.crew_people, c.basics, c.ratings, person="small ring"))
register("best_decade")(lambda c: people.best_decade(c.basics, c.ratings, c.crew_people, c.name))
register("best_decade_multi")(
    lambda c: people.best_decade(c.basics, c.ratings, c.crew_people, c.name, min_decades=2))
# Binding: 2 titles (5 selects no director in the driver's tables at sf 0.01).
register("genre_directors")(
    lambda c: people.genre_directors(c.basics, c.ratings, c.crew_people, c.name, min_films=2))
register("actor_directors")(lambda c: people.actor_directors(c.principals, c.crew_people, c.name))
register("actor_directors_sorted")(
    lambda c: people.actor_directors(c.principals, c.crew_people, c.name, order_by_name=True))
register("versatile_directors")(
    lambda c: people.versatile_directors(c.basics, c.ratings, c.crew_people, c.name))
register("versatile_game_directors")(
    lambda c: people.versatile_directors(c.basics, c.ratings, c.crew_people, None,
                                         title_type=VIDEO_GAME))
register("director_leaderboard")(
    lambda c: people.director_leaderboard(c.basics, c.crew_people, c.ratings, c.name))
register("director_leaderboard_left")(
    lambda c: people.director_leaderboard(c.basics, c.crew_people, c.ratings, c.name, name_join="left"))
register("actors_by_genre")(
    lambda c: people.actors_by_genre(c.basics, c.principals, c.ratings, c.name))
# Binding: 3 titles per (genre, director) before the top 5.
register("top5_directors_per_genre")(
    lambda c: people.top_directors_per_genre(c.basics, c.principals, c.name, c.ratings,
                                             min_count=3))
register("actors_in_best_episodes")(
    lambda c: people.actors_in_best_episodes(c.basics, c.principals, c.ratings, c.name))

# --- series ---------------------------------------------------------------
register("series_running_mean")(
    lambda c: series.series_running_mean(c.basics, c.ratings, c.episode))
register("series_running_mean_by_parent")(
    lambda c: series.series_running_mean(c.basics, c.ratings, c.episode, by="parent"))
register("episodes_per_title")(lambda c: series.episodes_per_title(c.basics, c.episode, c.ratings))
register("rating_growth")(lambda c: series.rating_growth(c.basics, c.ratings))

# --- regions and years ----------------------------------------------------
register("top3_series_per_region")(
    lambda c: regions.top_series_per_region(c.basics, c.ratings, c.akas))
register("most_localized")(lambda c: regions.most_localized(c.basics, c.akas))
register("genres_by_region")(lambda c: regions.genres_by_region(c.basics, c.akas, c.ratings))
register("genres_by_region_min_votes")(
    lambda c: regions.genres_by_region(c.basics, c.akas, c.ratings, min_votes=1000))
register("genre_trend_by_year")(lambda c: regions.genre_trend_by_year(c.basics, c.ratings))
register("genre_trend_min_votes")(
    lambda c: regions.genre_trend_by_year(c.basics, c.ratings, min_votes=1000))
register("trend_top_genres")(lambda c: regions.trend_of_top_genres(c.basics, c.ratings))

# --- title joins over the bucketed store ------------------------------------
TITLES = ("basics", "ratings")
register("acclaimed_popular_stored")(
    lambda c: (lambda s: titles.acclaimed_popular(s.basics, s.ratings))(stored(c, TITLES)))
register("genre_mean_rating_stored")(
    lambda c: (lambda s: titles.genre_mean_rating(s.basics, s.ratings))(stored(c, TITLES)))
register("series_running_mean_stored")(
    lambda c: (lambda s: series.series_running_mean(s.basics, s.ratings, s.episode))(
        stored(c, (*TITLES, "episode"))))
register("actors_in_acclaimed_stored")(
    lambda c: (lambda s: people.actors_in_acclaimed(s.basics, s.ratings, s.principals, s.name))(
        stored(c, (*TITLES, "principals"))))

# --- profiling --------------------------------------------------------------
register("dataset_info")(profiling.dataset_info)
register("column_info")(profiling.column_info)
register("preview_titles")(profiling.preview)
register("numeric_summary")(profiling.numeric_summary)
register("describe_columns")(profiling.describe_columns)
register("categorical_distincts")(profiling.categorical_distincts)
register("runtime_rating_corr")(profiling.runtime_rating_corr)
register("title_type_profile")(profiling.title_type_profile)
register("subset_means")(profiling.subset_means)

# --- ingest and sinks (round trips through shared scratch storage) ---------
register("scan_typed_tsv")(ingest.scan_typed_tsv)
register("scan_untyped_tsv")(ingest.scan_untyped_tsv)
register("clean_null_token")(ingest.clean_null_token)
for _t in ("basics", "akas", "crew", "episode", "ratings", "principals", "name"):
    register(f"shape_{_t}")(lambda c, _t=_t: ingest.shaped_round_trip(c, _t))
register("load_catalogue")(ingest.load_catalogue)
register("export_csv_auto")(ingest.export_csv_auto)
register("export_csv_n")(ingest.export_csv_n)
register("export_csv_partitioned")(ingest.export_csv_partitioned)
register("stringify_arrays")(ingest.stringify)
register("result_stats")(ingest.result_stats)
register("result_first_rows")(ingest.result_first_rows)
register("malformed_fields")(ingest.malformed_fields)
register("load_well_formed")(ingest.load_well_formed)
register("export_single_file")(ingest.export_single_file)


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Driver form: (spark, sf_dir) -> DataFrame over the star-schema tables."""
    def bind(fn: CatalogueQuery) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: fn(star_catalogue(spark, sf_dir))
    return {k: bind(fn) for k, fn in QUERIES.items()}
