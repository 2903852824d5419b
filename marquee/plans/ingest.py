"""Round trips through the dump reader (S1..S11) and the CSV sinks (K1..K6).

Each question writes whole catalogue tables or whole query results to a
fresh folder under the cluster's shared checkpoint folder, reads them back
through the operator under test and returns what was read.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators import profile
from marquee.operators.arrays import stringify_arrays
from marquee.plans import people, regions, titles
from marquee.session import scratch_path
from marquee.sinks import csv as sinks
from marquee.sources import tsv
from marquee.sources.catalogue import TABLES, Catalogue
from marquee.sources.schemas import RAW_SCHEMAS


def _dump(cat: Catalogue, table: str) -> str:
    spark = cat[table].sparkSession
    folder = scratch_path(spark, "dump")
    return tsv.write_dump(cat[table], table, folder)


def scan_typed_tsv(cat: Catalogue) -> DataFrame:
    """S1: titles written as a dump, read back typed, unshaped."""
    path = _dump(cat, "basics")
    return tsv.read_typed_tsv(cat.basics.sparkSession, path, RAW_SCHEMAS["basics"])


def scan_untyped_tsv(cat: Catalogue) -> DataFrame:
    """S2: episodes written as a dump, read back with every column a string."""
    path = _dump(cat, "episode")
    return tsv.read_untyped_tsv(cat.episode.sparkSession, path)


def clean_null_token(cat: Catalogue) -> DataFrame:
    """S3: the untyped episodes with the NULL token turned into NULL."""
    return tsv.clean_null_token(scan_untyped_tsv(cat))


def shaped_round_trip(cat: Catalogue, table: str) -> DataFrame:
    """S4..S10: one table written as a dump, read back and shaped."""
    path = _dump(cat, table)
    raw = tsv.read_typed_tsv(cat[table].sparkSession, path, RAW_SCHEMAS[table])
    return stringify_arrays(tsv.shape(table, raw))


def load_catalogue(cat: Catalogue) -> DataFrame:
    """S11: all seven tables dumped to one folder, loaded back, then profiled.

    The seven writes are independent jobs; they are submitted together so
    the scheduler can run them side by side.
    """
    spark = cat.basics.sparkSession
    folder = scratch_path(spark, "catalogue")
    with ThreadPoolExecutor(max_workers=len(TABLES)) as pool:
        for done in [pool.submit(tsv.write_dump, cat[t], t, folder) for t in TABLES]:
            done.result()
    loaded = tsv.load_catalogue(spark, folder)
    return profile.dataset_info({t: loaded[t] for t in TABLES})


def _read_back(df: DataFrame, label: str, export, *args) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, label)
    export(df, path, *args)
    return sinks.read_back(spark, path, sinks.csv_schema(df))


def export_csv_auto(cat: Catalogue) -> DataFrame:
    """K1: the in-genre ranking exported as it is sorted, read back."""
    return _read_back(titles.rank_in_genre(cat.basics, cat.ratings), "k1", sinks.export_csv_auto)


def export_csv_n(cat: Catalogue) -> DataFrame:
    """K2: best decades exported as 4 files in the question's order, read back."""
    return _read_back(people.best_decade(cat.basics, cat.ratings, cat.crew_people, cat.name),
                      "k2", sinks.export_csv_n, 4, [F.col("avg_rating").desc(), F.col("director")])


def export_csv_partitioned(cat: Catalogue) -> DataFrame:
    """K3: the yearly genre trend exported in one folder per genre, read back."""
    return _read_back(regions.genre_trend_by_year(cat.basics, cat.ratings), "k3",
                      sinks.export_csv_partitioned, "genre")


def stringify(cat: Catalogue) -> DataFrame:
    """K4: titles with every array column joined into a string."""
    return stringify_arrays(cat.basics)


def result_stats(cat: Catalogue) -> DataFrame:
    """K5: title and row count of the in-genre ranking."""
    return sinks.result_stats(titles.rank_in_genre(cat.basics, cat.ratings), "rank_in_genre")


def result_first_rows(cat: Catalogue) -> DataFrame:
    """K5: the first rows of the in-genre ranking and its row count, in one job."""
    return sinks.first_rows(titles.rank_in_genre(cat.basics, cat.ratings), "rank_in_genre",
                            [F.col("genre"), F.col("rank_within_genre"), F.col("tconst")])


def malformed_fields(cat: Catalogue) -> DataFrame:
    """S1: titles dumped with broken fields planted in some rows, loaded with
    the channel for them; what became of each field, counted."""
    spark = cat.basics.sparkSession
    folder = scratch_path(spark, "broken")
    number = F.substring("tconst", 3, 18).cast("bigint")
    raw = tsv.to_dump_layout("basics", cat.basics)
    broken = raw.select(*[
        F.when((number % 50 == 1) & F.lit(c == "startYear"), F.concat(F.lit("c. "), F.coalesce(F.col(c).cast("string"), F.lit("?"))))
        .when((number % 75 == 2) & F.lit(c == "runtimeMinutes"), F.lit("1h"))
        .when((number % 90 == 3) & F.lit(c == "isAdult"), F.lit("maybe"))
        .otherwise(F.col(c).cast("string")).alias(c) for c in raw.columns])
    tsv.write_lines(broken, tsv.dump_path(folder, "basics"))
    return tsv.malformed_report("basics", tsv.read_checked_tsv(spark, tsv.dump_path(folder, "basics"), "basics"))


def load_well_formed(cat: Catalogue) -> DataFrame:
    """S11: the ratings dumped with torn and broken lines among them, and the
    rows that load whole."""
    spark = cat.ratings.sparkSession
    folder = scratch_path(spark, "torn")
    number = F.substring("tconst", 3, 18).cast("bigint")
    raw = tsv.to_dump_layout("ratings", cat.ratings)
    torn = raw.withColumn("numVotes", F.when(number % 40 == 5, F.lit("many")).otherwise(F.col("numVotes").cast("string")))
    torn = torn.withColumn("averageRating", F.when(
        number % 60 == 6, F.concat(F.col("averageRating").cast("string"), F.lit("\t7\t7\t7"))).otherwise(
        F.col("averageRating").cast("string")))
    tsv.write_lines(torn, tsv.dump_path(folder, "ratings"))
    return tsv.well_formed("ratings", tsv.read_checked_tsv(spark, tsv.dump_path(folder, "ratings"), "ratings"))


def export_single_file(cat: Catalogue) -> DataFrame:
    """K6: top series per region written as one sorted file, read back."""
    return _read_back(regions.top_series_per_region(cat.basics, cat.ratings, cat.akas), "k6",
                      sinks.export_single_file, [F.col("region"), F.col("averageRating").desc()])
