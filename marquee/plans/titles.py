"""Questions about titles and their ratings.

Every function takes catalogue DataFrames and returns a DataFrame (ranks run
jobs for their checkpointed tables as they are built) whose rows are fully
determined: where the question keeps "the first n" rows, ties
are broken by further columns, ending at the title id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.fixed import (COMEDY, CURRENT_YEAR, DOCUMENTARY, MOVIE, ROMANCE, TITLE_WORD,
                           TV_EPISODE, UKRAINE_REGION, UKRAINIAN, VIDEO_GAME)
from marquee.functions.exprs import (combo_key, has_all, int_mean, mean_rating,
                                     stringify)
from marquee.operators.agg import materialize
from marquee.operators.rank import (best_per_group, global_dense_rank, ranked_in_order,
                                    top_k)

R, V = "averageRating", "numVotes"


def of_type(basics: DataFrame, title_type: str) -> DataFrame:
    return basics.where(F.col("titleType") == title_type)


def recent_top_rated(basics: DataFrame, ratings: DataFrame, *, title_type: str = MOVIE,
                     min_votes: int = 5000, after_year: int = 2000, k: int = 10) -> DataFrame:
    """Best rated titles of a type released after a year, with enough votes."""
    rows = (of_type(basics, title_type).where(F.col("startYear") > after_year)
            .join(ratings.where(F.col(V) >= min_votes), "tconst"))
    best = top_k(rows, [F.col(R).desc(), F.col(V).desc(), F.col("tconst")], k)
    return best.select("tconst", "primaryTitle", "startYear",
                       stringify("genres").alias("genres"), R, V)


def genre_popularity(basics: DataFrame, ratings: DataFrame) -> DataFrame:
    """Mean rating and mean votes per genre, over titles of every type."""
    rows = (basics.select("tconst", "genres").join(ratings, "tconst")
            .select(R, V, F.explode("genres").alias("genre")))
    return (rows.groupBy("genre")
            .agg(mean_rating(R).alias("avg_rating"), int_mean(V).alias("avg_votes"))
            .orderBy(F.col("avg_rating").desc(), "genre"))


def runtime_by_frequent_type(basics: DataFrame, *, min_rows: int = 1000) -> DataFrame:
    """Mean runtime of each title type that has at least ``min_rows`` titles.

    One aggregate computes the size and the mean together (no join back).
    """
    return (basics.where(F.col("titleType").isNotNull())
            .groupBy("titleType")
            .agg(F.count(F.lit(1)).alias("_n"), int_mean("runtimeMinutes").alias("avg_runtime"))
            .where(F.col("_n") >= min_rows)
            .select("titleType", "avg_runtime")
            .orderBy(F.col("avg_runtime").desc_nulls_last(), "titleType"))


def rank_in_genre(basics: DataFrame, ratings: DataFrame, *, min_votes: int = 100) -> DataFrame:
    """Rank (with gaps) of every rated title within each of its genres.

    After the title join the rows move once, in ranges of (genre, rating), so
    a genre holding most titles is not funnelled through one task; ranges
    follow each other in the wanted order.
    """
    rows = (basics.select("tconst", "primaryTitle", "genres")
            .join(ratings.where(F.col(V) > min_votes).select("tconst", R), "tconst")
            .select("tconst", "primaryTitle", F.explode("genres").alias("genre"), R))
    return ranked_in_order(rows, "genre", R, "tconst", "rank_within_genre")


def titles_in_language(akas: DataFrame, *, language: str = UKRAINIAN) -> DataFrame:
    """Localised titles in one language (duplicates kept)."""
    return akas.where(F.col("language") == language).select("titleId", "title")


def long_film_rank(basics: DataFrame, ratings: DataFrame, *, title_type: str = MOVIE,
                   min_runtime: int = 120) -> DataFrame:
    """Long titles with their dense rank by rating over the whole set."""
    rows = materialize(of_type(basics, title_type).where(F.col("runtimeMinutes") > min_runtime)
                       .select("tconst", "primaryTitle", "runtimeMinutes")
                       .join(ratings.select("tconst", R), "tconst"))
    ranked = global_dense_rank(rows, R, "rank_among_long")
    return (ranked.select("primaryTitle", "runtimeMinutes", R, "rank_among_long")
            .orderBy("rank_among_long", "primaryTitle", "runtimeMinutes"))


def acclaimed_popular(basics: DataFrame, ratings: DataFrame, *, title_type: str = MOVIE,
                      min_rating: float = 8.0, min_votes: int = 10000) -> DataFrame:
    """Titles rated above ``min_rating`` with more than ``min_votes`` votes."""
    good = ratings.where((F.col(R) > min_rating) & (F.col(V) > min_votes))
    return (good.join(of_type(basics, title_type), "tconst")
            .select("tconst", "primaryTitle", R, V))


def genre_mean_rating(basics: DataFrame, ratings: DataFrame, *,
                      title_type: str = MOVIE) -> DataFrame:
    """Number of rated titles and mean rating per genre for one title type."""
    rows = (of_type(basics, title_type).select("tconst", "genres").join(ratings, "tconst")
            .select(R, F.explode("genres").alias("genre")))
    return (rows.groupBy("genre")
            .agg(F.count(F.lit(1)).alias("count"), mean_rating(R).alias("avg_rating"))
            .orderBy(F.col("avg_rating").desc(), "genre"))


def dated_high_rated(basics: DataFrame, ratings: DataFrame, *, title_type: str = MOVIE,
                     min_rating: float = 7.0, akas: DataFrame | None = None,
                     language: str | None = None) -> DataFrame:
    """Dated titles rated above ``min_rating``.

    The question this answers asks for English titles, yet the computation
    it mirrors applies no language filter; that is the default here. Pass
    ``akas`` and ``language`` to keep only titles localised in a language.
    """
    rows = (of_type(basics, title_type).where(F.col("startYear").isNotNull())
            .join(ratings.where(F.col(R) > min_rating), "tconst"))
    if language is not None:
        if akas is None:
            raise ValueError("language filter needs the akas table")
        local = akas.where(F.col("language") == language).select(
            F.col("titleId").alias("tconst"))
        rows = rows.join(local, "tconst", "left_semi")
    return rows.select("tconst", "primaryTitle", "startYear", R, V)


def high_rated_in_genre(basics: DataFrame, ratings: DataFrame, *, genre: str = DOCUMENTARY,
                        title_type: str = MOVIE, min_rating: float = 7.5,
                        order_by_rating: bool = False) -> DataFrame:
    """Titles of a type in one genre rated above ``min_rating``."""
    rows = (of_type(basics, title_type).where(F.array_contains("genres", genre))
            .join(ratings.where(F.col(R) > min_rating), "tconst")
            .select("tconst", "primaryTitle", R, V))
    if order_by_rating:
        rows = rows.orderBy(F.col(R).desc(), "tconst")
    return rows


def longest_per_genre(basics: DataFrame, *, title_type: str = MOVIE) -> DataFrame:
    """The longest title of each genre (ties: lowest title id)."""
    rows = (of_type(basics, title_type)
            .where(F.col("runtimeMinutes").isNotNull() & F.col("genres").isNotNull())
            .select("tconst", "primaryTitle", "runtimeMinutes",
                    F.explode("genres").alias("genre")))
    best = best_per_group(rows, ["genre"], [F.col("runtimeMinutes").desc(), F.col("tconst")])
    return best.select("genre", "primaryTitle", "runtimeMinutes").orderBy("genre")


def genre_combinations(basics: DataFrame, ratings: DataFrame, *, title_type: str = MOVIE,
                       min_votes: int | None = None) -> DataFrame:
    """Per sorted genre combination (two or more genres): count, mean, last year."""
    rated = ratings.where(F.col(R).isNotNull())
    if min_votes is not None:
        rated = rated.where(F.col(V) >= min_votes)
    rows = (of_type(basics, title_type).where(F.size("genres") > 1)
            .select("tconst", "startYear", combo_key("genres").alias("genre_combo"))
            .join(rated, "tconst"))
    return (rows.groupBy("genre_combo")
            .agg(F.count(F.lit(1)).alias("movie_count"), mean_rating(R).alias("avg_rating"),
                 F.max("startYear").alias("latest_year"))
            .orderBy(F.col("latest_year").desc_nulls_last(), F.col("movie_count").desc(),
                     F.col("avg_rating").desc(), "genre_combo"))


def title_keyword(basics: DataFrame, ratings: DataFrame, *, needle: str = TITLE_WORD,
                  title_types: tuple[str, ...] = (VIDEO_GAME, TV_EPISODE),
                  min_rating: float = 7.5, min_votes: int = 20) -> DataFrame:
    """Titles of the given types whose primary or original title has ``needle``,
    from one scan of the titles."""
    hit = F.col("primaryTitle").contains(needle) | F.col("originalTitle").contains(needle)
    good = ratings.where((F.col(R) >= min_rating) & (F.col(V) >= min_votes))
    return (basics.where(F.col("titleType").isin(*title_types) & hit).join(good, "tconst")
            .select("originalTitle", R, V, "startYear")
            .orderBy(F.col(R).desc(), F.col(V).desc(), "originalTitle"))


def recent_genre_counts(basics: DataFrame, *, title_type: str = VIDEO_GAME,
                        current_year: int = CURRENT_YEAR, years: int = 5, k: int = 20) -> DataFrame:
    """Genres of recent titles: count and the most frequent title (top k).

    The most frequent title is the mode of primaryTitle within the genre
    (ties: the lowest title). It is found from per-(genre, title) counts, a
    shuffle on a fine key, then a top-1 per genre, so no per-genre map of all
    titles is ever held in one task.
    """
    rows = (of_type(basics, title_type)
            .where(F.col("startYear") >= current_year - years)
            .select("primaryTitle", F.explode("genres").alias("genre")))
    per_title = rows.groupBy("genre", "primaryTitle").agg(F.count(F.lit(1)).alias("_c"))
    mode = best_per_group(per_title, ["genre"], [F.col("_c").desc(), F.col("primaryTitle")])
    totals = per_title.groupBy("genre").agg(F.sum("_c").alias("count"))
    joined = totals.join(mode.select("genre", F.col("primaryTitle").alias("mostFrequentTitle")),
                         "genre", "left")
    return top_k(joined, [F.col("count").desc(), F.col("genre")], k).select(
        "genre", "count", "mostFrequentTitle")


def recent_popular(basics: DataFrame, ratings: DataFrame, *, title_type: str = VIDEO_GAME,
                   from_year: int = 2015, min_rating: float = 7.5,
                   min_votes: int = 10000) -> DataFrame:
    good = ratings.where((F.col(R) >= min_rating) & (F.col(V) >= min_votes))
    return (of_type(basics, title_type).where(F.col("startYear") >= from_year)
            .join(good, "tconst")
            .select("primaryTitle", "startYear", R, V)
            .orderBy(F.col(R).desc(), F.col(V).desc(), "primaryTitle", "startYear"))


def localized_genre_pair(basics: DataFrame, akas: DataFrame, ratings: DataFrame, *,
                         genres: tuple[str, ...] = (ROMANCE, COMEDY), region: str = UKRAINE_REGION,
                         min_rating: float = 7.0, min_votes: int = 1000) -> DataFrame:
    """Titles in all of ``genres`` with a non-original title in ``region``."""
    titles = (basics.where(has_all("genres", *genres))
              .select("tconst", "primaryTitle", "titleType", "genres"))
    local = (akas.where((F.col("region") == region) & (F.col("isOriginalTitle") == F.lit(False)))
             .select(F.col("titleId").alias("tconst"), F.col("title").alias("ukrainianTitle"))
             .distinct())
    good = ratings.where((F.col(R) >= min_rating) & (F.col(V) >= min_votes))
    return (titles.join(good, "tconst").join(local, "tconst")
            .select("tconst", "primaryTitle", "ukrainianTitle", "titleType",
                    stringify("genres").alias("genres"), R, V)
            .orderBy(F.col(R).desc(), F.col(V).desc(), "tconst", "ukrainianTitle"))
