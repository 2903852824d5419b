"""Questions about people: actors, directors, writers and their titles.

Aggregates run on person ids first and names are joined afterwards, so the
name join sees one row per person instead of one per credit. Where the
question groups by the *name text*, namesakes are merged after that join, as
the question asks. ``crew`` is the long table (tconst, nconst, role) of
``Catalogue.crew_people``: directors and writers are never listed and exploded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.fixed import (ACTING, ACTOR, DIRECTOR, LATIN_NAME, MOVIE, PERSON, THRILLER,
                           TV_EPISODE, VIDEO_GAME)
from marquee.functions.exprs import decade, exact, mean_from_sum, mean_rating
from marquee.operators.agg import materialize
from marquee.operators.bridge import credits_in, directors_of, person_ids
from marquee.operators.rank import (best_per_group, global_dense_rank, rank_within, top_k,
                                    top_k_per_group)

R, V = "averageRating", "numVotes"


def actors_in_acclaimed(basics: DataFrame, ratings: DataFrame, principals: DataFrame,
                        name: DataFrame, *, title_type: str = MOVIE,
                        min_rating: float = 8.2, min_known: int = 3) -> DataFrame:
    """Actors with >= ``min_known`` known titles: distinct acclaimed titles played in."""
    acclaimed = (basics.where(F.col("titleType") == title_type).select("tconst")
                 .join(ratings.where(F.col(R) > min_rating).select("tconst"), "tconst"))
    played = (credits_in(principals, ACTING).join(acclaimed, "tconst", "left_semi")
              .groupBy("nconst").agg(F.count_distinct("tconst").alias("movies_starred_in")))
    known = name.where(F.size("knownForTitles") >= min_known).select("nconst", "primaryName")
    return (played.join(known, "nconst")
            .select("nconst", "primaryName", "movies_starred_in")
            .orderBy(F.col("movies_starred_in").desc(), "nconst"))


def busiest_actors(principals: DataFrame, name: DataFrame, *, category: str = ACTOR,
                   min_credits: int = 10, k: int = 3) -> DataFrame:
    """The k people with most credit rows in a category (>= ``min_credits``).

    The limit is taken before the name join, as in the question: a top person
    without a name row drops out rather than being replaced.
    """
    counts = (principals.where(F.col("category") == category).groupBy("nconst")
              .agg(F.count(F.lit(1)).alias("film_count"))
              .where(F.col("film_count") >= min_credits))
    top = top_k(counts, [F.col("film_count").desc(), F.col("nconst")], k)
    return (top.join(name, "nconst").select("primaryName", "film_count")
            .orderBy(F.col("film_count").desc(), "primaryName"))


def actors_in_hits(principals: DataFrame, ratings: DataFrame, name: DataFrame, *,
                   category: str = ACTOR, min_rating: float = 8.0, min_votes: int = 1000,
                   k: int = 10) -> DataFrame:
    """The k people with most credits in well-rated popular titles, then names."""
    hits = ratings.where((F.col(R) > min_rating) & (F.col(V) > min_votes)).select("tconst")
    counts = (principals.where(F.col("category") == category)
              .join(hits, "tconst", "left_semi")
              .groupBy("nconst").agg(F.count(F.lit(1)).alias("high_rating_appearances")))
    top = top_k(counts, [F.col("high_rating_appearances").desc(), F.col("nconst")], k)
    return (top.join(name, "nconst").select("primaryName", "high_rating_appearances")
            .orderBy(F.col("high_rating_appearances").desc(), "primaryName"))


def games_per_director(basics: DataFrame, crew: DataFrame, name: DataFrame, *,
                       title_type: str = VIDEO_GAME) -> DataFrame:
    """Titles of a type per director *name* (namesakes add up)."""
    games = basics.where(F.col("titleType") == title_type).select("tconst")
    per_id = (directors_of(crew).join(games, "tconst", "left_semi")
              .groupBy("director").agg(F.count(F.lit(1)).alias("_n")))
    named = per_id.join(name.select(F.col("nconst").alias("director"), "primaryName"), "director")
    return (named.groupBy("primaryName").agg(F.sum("_n").cast("bigint").alias("num_video_games"))
            .orderBy(F.col("num_video_games").desc(), "primaryName"))


def titles_of_person(name: DataFrame, crew: DataFrame, basics: DataFrame, ratings: DataFrame,
                     *, person: str = PERSON, min_rating: float = 6.5,
                     min_votes: int = 200) -> DataFrame:
    """Well-rated titles that a named person directed or wrote.

    The person is resolved inside the plan (no collect to the driver); an
    unknown name gives an empty result.
    """
    who = person_ids(name, person)
    titles = crew.join(who, "nconst").select("tconst").distinct()
    good = ratings.where((F.col(R) >= min_rating) & (F.col(V) >= min_votes))
    return (titles.join(basics, "tconst").join(good, "tconst")
            .select("primaryTitle", "titleType", "startYear", R, V)
            .orderBy(F.col(R).desc(), F.col(V).desc(), "primaryTitle"))


def _director_ratings(basics: DataFrame, ratings: DataFrame, crew: DataFrame, *,
                      title_type: str | None, need_year: bool) -> DataFrame:
    titles = basics
    if title_type is not None:
        titles = titles.where(F.col("titleType") == title_type)
    if need_year:
        titles = titles.where(F.col("startYear").isNotNull())
    return (titles.join(ratings, "tconst").join(directors_of(crew), "tconst"))


def best_decade(basics: DataFrame, ratings: DataFrame, crew: DataFrame, name: DataFrame, *,
                title_type: str = MOVIE, min_decades: int = 1) -> DataFrame:
    """Each director's decade with the best mean rating (ties: earlier decade).

    With ``min_decades`` = 2 only directors active in several decades remain.
    """
    rows = (_director_ratings(basics, ratings, crew, title_type=title_type, need_year=True)
            .withColumn("decade", decade("startYear")))
    stats = rows.groupBy("director", "decade").agg(
        mean_rating(R).alias("avg_rating"), F.count(F.lit(1)).alias("movie_count"))
    if min_decades > 1:
        spread = (stats.groupBy("director").agg(F.count(F.lit(1)).alias("_d"))
                  .where(F.col("_d") >= min_decades).select("director"))
        stats = stats.join(spread, "director", "left_semi")
    best = best_per_group(stats, ["director"], [F.col("avg_rating").desc(), F.col("decade")])
    people = name.select(F.col("nconst").alias("director"), "primaryName")
    return (best.join(people, "director", "left")
            .select("primaryName", "director", "decade", "avg_rating", "movie_count")
            .orderBy(F.col("avg_rating").desc(), "director"))


def genre_directors(basics: DataFrame, ratings: DataFrame, crew: DataFrame, name: DataFrame,
                    *, genre: str = THRILLER, min_films: int = 5,
                    min_avg: float = 7.0) -> DataFrame:
    """Directors of dated titles in a genre with enough titles and a high mean."""
    titles = basics.where(F.array_contains("genres", genre))
    rows = _director_ratings(titles, ratings, crew, title_type=None, need_year=True)
    stats = (rows.groupBy("director")
             .agg(F.count("tconst").alias("film_count"), mean_rating(R).alias("avg_rating"))
             .where((F.col("film_count") >= min_films) & (F.col("avg_rating") >= min_avg)))
    people = name.select(F.col("nconst").alias("director"), "primaryName")
    return (stats.join(people, "director", "left")
            .select("director", "film_count", "avg_rating", "primaryName")
            .orderBy(F.col("avg_rating").desc(), "director"))


def actor_directors(principals: DataFrame, crew: DataFrame, name: DataFrame, *,
                    pattern: str = LATIN_NAME, order_by_name: bool = False) -> DataFrame:
    """People credited as actor/actress who are also listed as directors."""
    actors = credits_in(principals, ACTING).select("nconst").distinct()
    directors = directors_of(crew).select(F.col("director").alias("nconst")).distinct()
    both = actors.join(directors, "nconst", "left_semi")
    out = (both.join(name.where(F.col("primaryName").isNotNull()
                                & F.col("primaryName").rlike(pattern)), "nconst")
           .select("nconst", "primaryName"))
    if order_by_name:
        out = out.orderBy("primaryName", "nconst")
    return out


def versatile_directors(basics: DataFrame, ratings: DataFrame, crew: DataFrame,
                        name: DataFrame | None, *, title_type: str = MOVIE,
                        min_genres: int = 3, min_avg: float = 7.5) -> DataFrame:
    """Directors working in >= ``min_genres`` genres with mean rating > ``min_avg``.

    The mean is over (director, genre) rows, i.e. a title counts once per
    genre it has. Pass ``name=None`` for the id-only form.
    """
    titles = basics.where(F.col("genres").isNotNull())
    rows = (_director_ratings(titles, ratings, crew, title_type=title_type, need_year=False)
            .withColumn("genre", F.explode("genres")))
    stats = (rows.groupBy("director")
             .agg(F.count_distinct("genre").alias("genre_count"), mean_rating(R).alias("avg_rating"))
             .where((F.col("genre_count") >= min_genres) & (F.col("avg_rating") > min_avg)))
    if name is None:
        return (stats.select("director", "genre_count", "avg_rating")
                .orderBy(F.col("avg_rating").desc(), "director"))
    people = name.select(F.col("nconst").alias("director"), "primaryName")
    return (stats.join(people, "director", "left")
            .orderBy(F.col("avg_rating").desc(), "director")
            .select("primaryName", "genre_count", "avg_rating"))


def director_leaderboard(basics: DataFrame, crew: DataFrame, ratings: DataFrame,
                         name: DataFrame, *, title_type: str = MOVIE, min_votes: int = 1000,
                         min_movies: int = 10, name_join: str = "inner") -> DataFrame:
    """Directors (by name text) with >= ``min_movies`` titles, dense-ranked by mean.

    ``name_join='left'`` keeps directors without a name row; they pool into
    one NULL-named group, which is ranked like any other.
    """
    titles = basics.where(F.col("titleType") == title_type).select("tconst")
    rows = (directors_of(crew).join(titles, "tconst", "left_semi")
            .join(ratings.where((F.col(V) >= min_votes) & F.col(R).isNotNull()), "tconst"))
    per_id = rows.groupBy("director").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(exact(R)).alias("_s"))
    people = name.select(F.col("nconst").alias("director"), "primaryName")
    named = per_id.join(people, "director", name_join)
    stats = (named.groupBy(F.col("primaryName").alias("director"))
             .agg(F.sum("_n").cast("bigint").alias("movie_count"),
                  mean_from_sum(F.sum("_s"), F.sum("_n")).alias("avg_rating"))
             .where(F.col("movie_count") >= min_movies))
    # One row per director name, read by the rank lookup and the join back.
    ranked = global_dense_rank(materialize(stats), "avg_rating", "rank")
    return (ranked.select("director", "movie_count", "avg_rating", "rank",
                          F.lit(DIRECTOR).alias("role"))
            .orderBy("rank", "director"))


def actors_by_genre(basics: DataFrame, principals: DataFrame, ratings: DataFrame,
                    name: DataFrame, *, title_type: str = MOVIE, min_votes: int = 1000,
                    min_movies: int = 10, high_rating: float = 7.0) -> DataFrame:
    """Per genre, actors/actresses (by name) ranked by their count of high-rated rows.

    A person qualifies with >= ``min_movies`` (title, genre) rows overall. One
    aggregate per (genre, id) gives both counts, names are joined to those and
    summed; the per-name total is a second small aggregate, and the dense rank
    per genre runs on a (genre, count) value table.
    """
    titles = (basics.where((F.col("titleType") == title_type) & F.col("startYear").isNotNull())
              .select("tconst", "genres"))
    rated = ratings.where(F.col(R).isNotNull() & (F.col(V) >= min_votes)).select("tconst", R)
    rows = (credits_in(principals, ACTING).join(titles.join(rated, "tconst"), "tconst")
            .select("nconst", R, F.explode("genres").alias("genre")))
    per_id = rows.groupBy("genre", "nconst").agg(
        F.count(F.lit(1)).alias("_n"), F.count(F.when(F.col(R) >= high_rating, 1)).alias("_high"))
    per = (per_id.join(name.select("nconst", "primaryName"), "nconst")
           .groupBy("genre", "primaryName").agg(
               F.sum("_n").alias("_all"),
               F.sum("_high").cast("bigint").alias("high_rated_movie_count")))
    totals = (per.groupBy("primaryName").agg(F.sum("_all").alias("_total"))
              .where(F.col("_total") >= min_movies).select("primaryName"))
    kept = (per.where(F.col("high_rated_movie_count") > 0)
            .join(totals, "primaryName", "left_semi"))
    # The aggregate feeds both the rank lookup and the final join: checkpoint
    # it once (one row per genre and name) instead of recomputing the joins.
    kept = materialize(kept)
    ranked = rank_within(kept, ["genre"], "high_rated_movie_count", "rank", dense=True)
    return (ranked.select("genre", "primaryName", "high_rated_movie_count", "rank")
            .orderBy("genre", "rank", "primaryName"))


def top_directors_per_genre(basics: DataFrame, principals: DataFrame, name: DataFrame,
                            ratings: DataFrame, *, title_type: str = MOVIE,
                            min_votes: int = 1000, min_count: int = 10,
                            k: int = 5) -> DataFrame:
    """Per genre, the k best director names (credited as director) by mean rating."""
    titles = (basics.where((F.col("titleType") == title_type) & F.col("genres").isNotNull())
              .select("tconst", "genres")
              .join(ratings.where(F.col(V) >= min_votes).select("tconst", R), "tconst"))
    rows = (credits_in(principals, [DIRECTOR]).join(titles, "tconst")
            .select("nconst", R, F.explode("genres").alias("genre")))
    per_id = rows.groupBy("genre", "nconst").agg(
        F.sum(exact(R)).alias("_s"), F.count(R).alias("_r"), F.count(F.lit(1)).alias("_n"))
    people = name.select("nconst", F.col("primaryName").alias("director_name"))
    stats = (per_id.join(people, "nconst").groupBy("genre", "director_name")
             .agg(mean_from_sum(F.sum("_s"), F.sum("_r")).alias("avg_rating"),
                  F.sum("_n").cast("bigint").alias("movie_count"))
             .where(F.col("movie_count") >= min_count))
    top = top_k_per_group(stats, ["genre"], [F.col("avg_rating").desc(),
                                             F.col("movie_count").desc(),
                                             F.col("director_name")], k, rank_col="rank")
    return (top.select("genre", "director_name", "avg_rating", "movie_count", "rank")
            .orderBy("genre", "rank"))


def actors_in_best_episodes(basics: DataFrame, principals: DataFrame, ratings: DataFrame,
                            name: DataFrame, *, title_type: str = TV_EPISODE,
                            category: str = ACTOR) -> DataFrame:
    """Actors (by name) in the top-rated episodes of each year (all ties kept).

    ``dense_rank() = 1`` per year is the same as "rating equals the year's
    best", so the best rating per year is computed on a per-year table and
    joined back (the rated episodes feed both and are written once); the NULL
    year is a group of its own. Roles are counted per id and year before names
    are joined.
    """
    eps = materialize(basics.where(F.col("titleType") == title_type).select("tconst", "startYear")
                      .join(ratings.select("tconst", R), "tconst"))
    best = eps.groupBy("startYear").agg(F.max(R).alias("_best")).select(
        F.col("startYear").alias("_y"), "_best")
    top = (eps.join(best, eps["startYear"].eqNullSafe(best["_y"]) & (eps[R] == best["_best"]))
           .select("tconst", "startYear", R))
    per_id = (principals.where(F.col("category") == category).select("tconst", "nconst")
              .join(top, "tconst").groupBy("nconst", "startYear")
              .agg(F.sum(exact(R)).alias("_s"), F.count(F.lit(1)).alias("_n")))
    return (per_id.join(name.select("nconst", "primaryName"), "nconst")
            .groupBy("primaryName", "startYear")
            .agg(F.sum("_n").cast("bigint").alias("roleCount"),
                 mean_from_sum(F.sum("_s"), F.sum("_n")).alias("avgRating"))
            .orderBy(F.col("roleCount").desc(), F.col("avgRating").desc(),
                     "primaryName", "startYear"))
