"""Bind the catalogue to the driver's star-schema Parquet tables.

The title/name dumps are not available where this runs, so each catalogue
table is derived from the order, line, customer, part, supplier, nation and
region tables with plain integer arithmetic. The same formulas exist as SQL
in :mod:`marquee.oracle.catalogue_sql`; both sides must stay identical.

Notation: ``k`` order key, ``c`` customer key, ``P`` = floor(total price) as
bigint, ``p`` part key. Every derivation is a projection, a filter, an
equi-join or a per-key aggregate, so it scales with the input tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.sources.catalogue import Catalogue

# --- fixed values of the binding ----------------------------------------
# Genre vocabulary.
GENRES = ["Drama", "Comedy", "Romance", "Thriller", "Documentary",
          "Action", "Horror", "Sci-Fi", "Family", "Crime",
          "Adventure", "Animation", "Biography", "Fantasy", "Film-Noir",
          "Game-Show", "History", "Music", "Musical", "Mystery",
          "News", "Reality-TV", "Short", "Sport", "Talk-Show", "War", "Western"]
# Credit category by return flag + line status.
CATEGORY_BY_FLAGS = {"AF": "actor", "AO": "actress", "NF": "director",
                     "NO": "writer", "RF": "producer", "RO": "actor"}
# Language by region name.
LANGUAGE_BY_REGION = {"EUROPE": "uk", "ASIA": "ja", "AMERICA": "en", "MIDDLE EAST": "und"}
# Kinds of localised title by return flag.
TYPES_BY_FLAG = {"A": ["alternative"], "N": ["dvd", "festival"]}
UA_NATION_KEY = 15
FIRST_YEAR, YEAR_SPAN = 1990, 36
FIRST_BIRTH_YEAR = 1930
# A person is known for the titles they act in with at least this line quantity.
KNOWN_QUANTITY = 46
# -------------------------------------------------------------------------


def read_star(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _key(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def _case(c: Column, mapping: dict[str, str]) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(c == k, v) if out is None else out.when(c == k, v))
    return out.otherwise(F.lit(None).cast("string"))


def _lists(c: Column, mapping: dict[str, list[str]]) -> Column:
    out = F.lit(None).cast(T.ArrayType(T.StringType()))
    for k, v in mapping.items():
        out = F.when(c == k, F.array(*map(F.lit, v))).otherwise(out)
    return out


def _idiv(sql: str, n: int) -> Column:
    """Integer division (SQL ``div``) of a bigint expression, exact at any size."""
    return F.expr(f"({sql}) div {n}")


def _price_floor(c: Column) -> Column:
    return F.floor(c).cast("bigint")


def basics(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_star(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    c = read_star(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey)
    k, cust = F.col("o_orderkey"), F.col("o_custkey")
    price = _price_floor(F.col("o_totalprice"))
    vocab = F.array(*[F.lit(g) for g in GENRES])

    def genre(i: Column) -> Column:
        return F.element_at(vocab, (i % len(GENRES) + 1).cast("int"))

    shift = _idiv("o_orderkey", 10) % 4
    three = F.array(genre(cust), genre(cust + 1 + shift), genre(cust + 5 + shift))
    n_genres = (1 + _idiv("o_orderkey", 7) % 3).cast("int")
    kind = k % 10
    year = F.when(k % 37 != 0, (FIRST_YEAR + _idiv("o_orderkey", 10) % YEAR_SPAN).cast("int"))
    ended = (kind == 5) & (F.col("o_orderstatus") == "F")
    return j.select(
        _key("tt", k).alias("tconst"),
        F.when(kind < 5, "movie").when(kind == 5, "tvSeries")
         .when(kind.isin(6, 7), "tvEpisode").when(kind == 8, "videoGame")
         .otherwise("short").alias("titleType"),
        F.concat_ws(" ", F.col("c_mktsegment"), cust.cast("string")).alias("primaryTitle"),
        F.concat_ws(" ", F.col("o_orderpriority"), cust.cast("string")).alias("originalTitle"),
        (k % 20 == 0).alias("isAdult"),
        year.alias("startYear"),
        F.when(ended, year + (price % 10).cast("int")).alias("endYear"),
        F.when(k % 11 != 0, (20 + price % 200).cast("int")).alias("runtimeMinutes"),
        F.when(k % 13 != 0, F.slice(three, 1, n_genres)).alias("genres"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rating per order, from the sum of its lines' prices; an order without
    lines is unrated."""
    li = read_star(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice")
    total = li.groupBy("l_orderkey").agg(F.sum(_price_floor(F.col("l_extendedprice"))).alias("_s"))
    k, price = F.col("l_orderkey"), F.col("_s")
    return total.select(
        _key("tt", k).alias("tconst"),
        ((10 + price % 91).cast("double") / 10.0).alias("averageRating"),
        ((price * 7919) % 20000).cast("int").alias("numVotes"),
    )


def principals(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_star(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus")
    flags = F.concat(F.col("l_returnflag"), F.col("l_linestatus"))
    category = _case(flags, CATEGORY_BY_FLAGS)
    return li.select(
        _key("tt", F.col("l_orderkey")).alias("tconst"),
        F.col("l_linenumber").cast("int").alias("ordering"),
        _key("nm", F.col("l_partkey")).alias("nconst"),
        category.alias("category"),
        F.when(category.isin("writer", "producer"),
               F.concat(F.lit("line "), F.col("l_linenumber").cast("string"))).alias("job"),
        F.when(category.isin("actor", "actress"),
               F.concat(F.lit('["Role '), F.col("l_suppkey").cast("string"), F.lit('"]')))
         .alias("characters"),
    )


def crew_people(credits: DataFrame) -> DataFrame:
    """(tconst, nconst, role): each director and writer of a title once. The
    long form the questions read; no list is built for them."""
    return (credits.where(F.col("category").isin("director", "writer"))
            .select("tconst", "nconst", F.col("category").alias("role")).distinct())


def crew(credits: DataFrame) -> DataFrame:
    """Per title: sorted distinct directors and writers, NULL when none.

    Both parts pre-aggregate before their shuffle, so a title with a huge
    number of credit rows is reduced map-side: the set of titles with any
    credit is a partial count, and the lists are partial sets built from the
    director and writer rows only. The two per-title tables join one to one.
    """
    def role(r: str) -> Column:
        s = F.array_sort(F.collect_set(F.when(F.col("category") == r, F.col("nconst"))))
        return F.when(F.size(s) > 0, s)

    titles = credits.groupBy("tconst").agg(F.count(F.lit(1)).alias("_c")).select("tconst")
    lists = (credits.where(F.col("category").isin("director", "writer"))
             .groupBy("tconst")
             .agg(role("director").alias("directors"), role("writer").alias("writers")))
    # Titles with credits but no director or writer keep a row of NULLs.
    return titles.join(lists, "tconst", "left")


def name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People from parts; known for the titles they act in with a large quantity."""
    part = read_star(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    li = read_star(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus")
    acting = [k for k, v in CATEGORY_BY_FLAGS.items() if v in ("actor", "actress")]
    known = (li.where((F.col("l_quantity") >= KNOWN_QUANTITY)
                      & F.concat("l_returnflag", "l_linestatus").isin(*acting))
             .groupBy(F.col("l_partkey").alias("p_partkey"))
             .agg(F.array_sort(F.collect_set(_key("tt", F.col("l_orderkey")))).alias("_known")))
    p = F.col("p_partkey")
    born = F.when(p % 9 != 0, (FIRST_BIRTH_YEAR + F.col("p_size")).cast("int"))
    died = F.when(F.col("p_size") < 20, born + (60 + _price_floor(F.col("p_retailprice")) % 30).cast("int"))
    return part.join(known, "p_partkey", "left").select(
        _key("nm", p).alias("nconst"),
        F.when(p % 2 == 0, F.col("p_name"))
         .otherwise(F.concat_ws(" ", F.col("p_name"), F.col("p_brand"))).alias("primaryName"),
        born.alias("birthYear"),
        died.alias("deathYear"),
        F.when(p % 7 != 0, F.array(F.lower("p_type"), F.lower("p_brand"))).alias("primaryProfession"),
        F.col("_known").alias("knownForTitles"),
    )


def akas(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_star(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus")
    s = read_star(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read_star(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_star(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (li.join(s, li.l_suppkey == s.s_suppkey)
           .join(n, F.col("s_nationkey") == n.n_nationkey)
           .join(r, F.col("n_regionkey") == r.r_regionkey))
    line = F.col("l_linenumber")
    return j.select(
        _key("tt", F.col("l_orderkey")).alias("titleId"),
        line.cast("int").alias("ordering"),
        F.concat(F.lit("aka "), F.col("s_name")).alias("title"),
        F.when(line == 7, F.lit(None).cast("string"))
         .when(F.col("n_nationkey") == UA_NATION_KEY, "UA")
         .otherwise(F.col("n_name")).alias("region"),
        _case(F.col("r_name"), LANGUAGE_BY_REGION).alias("language"),
        _lists(F.col("l_returnflag"), TYPES_BY_FLAG).alias("types"),
        F.when(F.col("l_linestatus") == "F",
               F.array(F.concat(F.lower("n_name"), F.lit(" title")), F.lit("literal"))).alias("attributes"),
        (line == 1).alias("isOriginalTitle"),
    )


def episode(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_star(spark, sf_dir, "orders").select("o_orderkey")
    k = F.col("o_orderkey")
    return o.where((k % 10).isin(6, 7)).select(
        _key("tt", k).alias("tconst"),
        _key("tt", _idiv("o_orderkey", 200) * 200 + 5).alias("parentTconst"),
        F.when(k % 17 != 0, (1 + _idiv("o_orderkey", 10) % 4).cast("int")).alias("seasonNumber"),
        (_idiv("o_orderkey % 200", 40) + 1).cast("int").alias("episodeNumber"),
    )


def star_catalogue(spark: SparkSession, sf_dir: str) -> Catalogue:
    """The seven catalogue tables over the driver's tables in ``sf_dir``, lazy,
    over the files that are there now."""
    holder: dict[str, DataFrame] = {}

    def credits() -> DataFrame:
        if "principals" not in holder:
            holder["principals"] = principals(spark, sf_dir)
        return holder["principals"]

    return Catalogue({
        "basics": lambda: basics(spark, sf_dir),
        "ratings": lambda: ratings(spark, sf_dir),
        "principals": credits,
        "crew": lambda: crew(credits()),
        "crew_people": lambda: crew_people(credits()),
        "name": lambda: name(spark, sf_dir),
        "akas": lambda: akas(spark, sf_dir),
        "episode": lambda: episode(spark, sf_dir),
    })
