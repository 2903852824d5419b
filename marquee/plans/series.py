"""Questions over ordered series: episodes of a show, releases of a title."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.fixed import TV_EPISODE, VIDEO_GAME
from marquee.operators.series import (child_counts, previous_value, rounded_growth,
                                      running_mean_rating)

R, V = "averageRating", "numVotes"


def series_running_mean(basics: DataFrame, ratings: DataFrame, episode: DataFrame, *,
                        by: str = "title") -> DataFrame:
    """Running mean rating of episodes in (season, episode) order per series.

    ``by='title'`` partitions by the series *title text*, so same-named series
    share one running mean (the question's grouping); ``by='parent'`` uses
    the series id instead.
    """
    eps = (basics.where(F.col("titleType") == TV_EPISODE).select("tconst")
           .join(ratings.select("tconst", R), "tconst")
           .join(episode.select("tconst", "parentTconst", "seasonNumber", "episodeNumber"),
                 "tconst"))
    series = basics.select(F.col("tconst").alias("parentTconst"),
                           F.col("primaryTitle").alias("series_title"))
    order, out = ["seasonNumber", "episodeNumber"], "cumulative_avg_rating"
    cols = ["series_title", "seasonNumber", "episodeNumber", R, out]
    key = "series_title"
    if by != "title":
        key = "parentTconst"
        cols.insert(1, key)
    rows = running_mean_rating(eps.join(series, "parentTconst"), key, order, R, out)
    return rows.select(*cols).sortWithinPartitions(
        key, F.col("seasonNumber").asc_nulls_first(), F.col("episodeNumber").asc_nulls_first(), R)


def episodes_per_title(basics: DataFrame, episode: DataFrame, ratings: DataFrame) -> DataFrame:
    """Episodes counted per title, for *every* rated title (0 when none).

    Episodes are counted per parent first (partial aggregate), then joined to
    the titles, instead of joining every episode row to its parent.
    """
    counts = child_counts(episode, "parentTconst", "episodeNumber", "_eps")
    titles = basics.select("tconst", "primaryTitle").join(ratings.select("tconst", R), "tconst")
    joined = titles.join(counts.withColumnRenamed("parentTconst", "tconst"), "tconst", "left")
    return (joined.select("primaryTitle",
                          F.coalesce(F.col("_eps"), F.lit(0)).cast("bigint").alias("num_episodes"),
                          R)
            .orderBy(F.col("num_episodes").desc(), "primaryTitle", R))


def rating_growth(basics: DataFrame, ratings: DataFrame, *, title_type: str = VIDEO_GAME,
                  min_votes: int = 500) -> DataFrame:
    """Rating rise over the previous release with the same title text.

    Releases are ordered by start year (NULL first), then id. The vote filter
    applies after the previous release is found, as in the question.
    """
    rows = (basics.where(F.col("titleType") == title_type)
            .select("tconst", "primaryTitle", "startYear")
            .join(ratings, "tconst"))
    lagged = previous_value(rows, "primaryTitle", ["startYear", "tconst"], R, "_prev")
    grown = lagged.withColumn("rating_growth", rounded_growth(F.col(R), F.col("_prev")))
    return (grown.where((F.col("rating_growth") > 0) & (F.col(V) >= min_votes))
            .select("primaryTitle", "startYear", R, V, "rating_growth")
            .orderBy(F.col("rating_growth").desc(), "primaryTitle", "startYear"))
