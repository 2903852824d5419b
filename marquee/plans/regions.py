"""Questions over localised titles (regions) and release years."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.fixed import MOVIE, TV_SERIES, UNDETERMINED, VIDEO_GAME
from marquee.functions.exprs import exact, mean_from_sum
from marquee.operators.rank import top_k, top_k_per_group

R, V = "averageRating", "numVotes"


def top_series_per_region(basics: DataFrame, ratings: DataFrame, akas: DataFrame, *,
                          title_type: str = TV_SERIES, min_rating: float = 7.0,
                          min_votes: int = 1000, k: int = 3) -> DataFrame:
    """Per region, the k best rated titles of a type (row_number, partial limit).

    Several localised rows of one title in a region each take a place, as in
    the question; ties after (rating, votes, title) go to the lower id.
    """
    good = ratings.where((F.col(R) >= min_rating) & (F.col(V) >= min_votes))
    titles = (basics.where(F.col("titleType") == title_type).select("tconst", "primaryTitle")
              .join(good, "tconst"))
    local = (akas.where(F.col("region").isNotNull())
             .select(F.col("titleId").alias("tconst"), "region"))
    rows = titles.join(local, "tconst")
    top = top_k_per_group(rows, ["region"], [F.col(R).desc(), F.col(V).desc(),
                                             F.col("primaryTitle"), F.col("tconst")], k)
    return (top.select("region", "primaryTitle", R, V)
            .orderBy("region", F.col(R).desc(), F.col(V).desc(), "primaryTitle"))


def most_localized(basics: DataFrame, akas: DataFrame, *,
                   title_type: str = VIDEO_GAME, skip_language: str = UNDETERMINED) -> DataFrame:
    """Distinct regions per title text among localised rows.

    ``language <> 'und'`` also drops rows with no language; a NULL region is
    not counted, so a title can have 0.
    """
    titles = basics.where(F.col("titleType") == title_type).select("tconst", "primaryTitle")
    local = (akas.where(F.col("language") != skip_language)
             .select(F.col("titleId").alias("tconst"), "region"))
    return (titles.join(local, "tconst").groupBy("primaryTitle")
            .agg(F.count_distinct("region").alias("localization_count"))
            .orderBy(F.col("localization_count").desc(), "primaryTitle"))


def genres_by_region(basics: DataFrame, akas: DataFrame, ratings: DataFrame, *,
                     title_type: str = MOVIE, min_votes: int | None = None) -> DataFrame:
    """Per (region, genre): distinct titles, mean rating, dense rank in region.

    The mean counts a title once per localised row it has in the region. The
    akas rows are first reduced to (title, region, rows) and joined to titles
    once; the mean is then a weighted exact sum. A genre's first place in a
    title's rows is marked before that join, so distinct titles are a plain
    count and no task holds a table of (region, genre, title).
    """
    rated = ratings
    if min_votes is not None:
        rated = rated.where(F.col(V) >= min_votes)
    titles = (basics.where((F.col("titleType") == title_type) & F.col("genres").isNotNull())
              .select("tconst", "genres").join(rated.select("tconst", R), "tconst"))
    # The join leaves a title's rows together; of them only the lists differ.
    earlier = F.collect_set("genres").over(
        Window.partitionBy("tconst").rowsBetween(Window.unboundedPreceding, -1))
    titles = titles.withColumn("_earlier", F.flatten(earlier)).select("tconst", R, F.transform(
        "genres", lambda g, i: F.struct(g.alias("genre"), (
            ~F.exists("_earlier", lambda e: e.eqNullSafe(g))
            & ~F.exists(F.slice("genres", 1, i), lambda e: e.eqNullSafe(g))).alias("first"))).alias("genres"))
    per_region = (akas.where(F.col("region").isNotNull())
                  .groupBy(F.col("titleId").alias("tconst"), "region")
                  .agg(F.count(F.lit(1)).alias("_w")))
    rows = (titles.join(per_region, "tconst")
            .select("region", "_w", R, F.explode("genres").alias("_g"))
            .select("region", "_w", R, "_g.genre", "_g.first"))
    if min_votes is not None:
        rows = rows.where(F.col("genre").isNotNull())
    stats = rows.groupBy("region", "genre").agg(
        F.count(F.when(F.col("first"), 1)).alias("title_count"),
        mean_from_sum(F.sum(exact(R) * F.col("_w")), F.sum("_w")).alias("avg_rating"))
    # One row per (region, genre): the per-region window is over a small table.
    w = Window.partitionBy("region").orderBy(F.col("title_count").desc())
    return (stats.withColumn("rank", F.dense_rank().over(w).cast("bigint"))
            .orderBy("region", "rank", "genre"))


def genre_trend_by_year(basics: DataFrame, ratings: DataFrame, *, title_type: str = MOVIE,
                        min_votes: int | None = None) -> DataFrame:
    """Per (year, genre): count, mean rating, mean votes, dense rank in year.

    Titles are summed per year and list of genres, a partial aggregate; the
    few sums are exploded instead of the titles.
    """
    rated = ratings.where(F.col(R).isNotNull())
    if min_votes is not None:
        rated = rated.where(F.col(V) >= min_votes)
    rows = (basics.where((F.col("titleType") == title_type) & F.col("startYear").isNotNull()
                         & (F.size("genres") > 0))
            .select("tconst", "startYear", "genres")
            .join(rated.select("tconst", R, V), "tconst"))
    lists = rows.groupBy("startYear", "genres").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(exact(R)).alias("_r"),
        F.sum(F.col(V).cast("bigint")).alias("_v"), F.count(V).alias("_nv"))
    stats = (lists.select("startYear", "_n", "_r", "_v", "_nv", F.explode("genres").alias("genre"))
             .groupBy("startYear", "genre").agg(
                 F.sum("_n").alias("movie_count"), mean_from_sum(F.sum("_r"), F.sum("_n")).alias("avg_rating"),
                 mean_from_sum(F.sum("_v"), F.sum("_nv")).alias("avg_votes")))
    w = Window.partitionBy("startYear").orderBy(F.col("movie_count").desc())
    return (stats.withColumn("rank", F.dense_rank().over(w).cast("bigint"))
            .orderBy(F.col("startYear").desc(), "rank", "genre"))


def trend_of_top_genres(basics: DataFrame, ratings: DataFrame, *, title_type: str = MOVIE,
                        k: int = 20) -> DataFrame:
    """Year series of counts for the k genres with the largest total count."""
    trend = genre_trend_by_year(basics, ratings, title_type=title_type)
    totals = trend.groupBy("genre").agg(F.sum("movie_count").alias("_total"))
    best = top_k(totals, [F.col("_total").desc(), F.col("genre")], k).select("genre")
    # At most k rows: a bounded broadcast.
    return (trend.join(F.broadcast(best), "genre", "left_semi")
            .select("startYear", "genre", "movie_count")
            .orderBy("genre", "startYear"))
