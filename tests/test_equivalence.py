"""The scalable operators equal the plain window forms they replace.

Random small frames (hypothesis) with few groups, one hot group, ties and
NULLs are ranked both ways in Spark and compared row for row.
"""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from marquee.functions.exprs import exact, mean_from_sum
from marquee.operators import ranges
from marquee.operators.rank import global_dense_rank, rank_within, ranked_in_order, top_k_per_group
from marquee.operators.series import previous_value, running_mean_rating

ROWS = st.lists(
    st.tuples(
        st.sampled_from(["hot", "hot", "hot", "a", "b", None]),       # group (hot-skewed)
        st.one_of(st.none(), st.integers(40, 400).map(lambda v: v / 40)),  # up to three decimals
        st.one_of(st.none(), st.integers(1990, 1995)),                  # coarse order
    ),
    min_size=1, max_size=60)

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow])


def frame(spark, rows):
    data = [(f"t{i:03d}", g, v, y) for i, (g, v, y) in enumerate(rows)]
    return spark.createDataFrame(data, "id string, g string, v double, y int")


def as_set(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


@SETTINGS
@given(rows=ROWS)
def test_rank_within_equals_window(spark, rows):
    df = frame(spark, rows)
    w = Window.partitionBy("g").orderBy(F.col("v").desc())
    plain = df.withColumn("r", F.rank().over(w)).withColumn("d", F.dense_rank().over(w))
    fast = rank_within(rank_within(df, ["g"], "v", "r"), ["g"], "v", "d", dense=True)
    cols = ["id", "g", "v", "r", "d"]
    assert as_set(fast, cols) == as_set(plain, cols)


@SETTINGS
@given(rows=ROWS)
def test_global_dense_rank_equals_window(spark, rows):
    df = frame(spark, rows)
    plain = df.withColumn("d", F.dense_rank().over(Window.orderBy(F.col("v").desc())))
    fast = global_dense_rank(df, "v", "d")
    assert as_set(fast, ["id", "d"]) == as_set(plain, ["id", "d"])


@SETTINGS
@given(rows=ROWS)
def test_previous_value_equals_lag(spark, rows):
    df = frame(spark, rows)
    w = Window.partitionBy("g").orderBy(F.col("y").asc_nulls_first(), F.col("id"))
    plain = df.withColumn("p", F.lag("v").over(w))
    fast = previous_value(df, "g", ["y", "id"], "v", "p")
    assert as_set(fast, ["id", "p"]) == as_set(plain, ["id", "p"])


@SETTINGS
@given(rows=ROWS)
def test_running_mean_equals_window(spark, rows):
    df = frame(spark, rows)
    w = Window.partitionBy("g").orderBy(F.col("y").asc_nulls_first())
    plain = df.withColumn("m", mean_from_sum(F.sum(exact("v")).over(w), F.count("v").over(w)))
    fast = running_mean_rating(df, "g", ["y"], "v", "m")
    assert as_set(fast, ["id", "m"]) == as_set(plain, ["id", "m"])


@SETTINGS
@given(rows=ROWS)
def test_prefix_sums_equal_window(spark, rows):
    from marquee.operators.prefix import prefix_sums
    df = frame(spark, rows).withColumn("one", F.lit(1))
    order = [F.col("y").asc_nulls_first(), F.col("id")]
    w = Window.partitionBy("g").orderBy(*order)
    # Decimal sums, as the operators use: exact in any order.
    plain = (df.withColumn("s", F.coalesce(F.sum(exact("v")).over(w), F.lit(0)))
               .withColumn("c", F.sum("one").over(w.rowsBetween(Window.unboundedPreceding, -1))))
    fast = prefix_sums(df, ["g"], order, {"s": exact("v")})
    fast_before = prefix_sums(df, ["g"], order, {"c": F.col("one")}, inclusive=False)
    assert as_set(fast, ["id", "s"]) == as_set(plain, ["id", "s"])
    got = {r.id: r.c for r in fast_before.collect()}
    assert got == {r.id: (r.c or 0) for r in plain.collect()}


def test_top_k_per_group_keeps_k(spark):
    df = frame(spark, [("hot", v / 10, 1990) for v in range(10, 60)] + [("a", 5.0, 1991)])
    top = top_k_per_group(df, ["g"], [F.col("v").desc(), F.col("id")], 3, rank_col="rk")
    got = as_set(top, ["g", "v", "rk"])
    assert got == sorted([("a", 5.0, 1), ("hot", 5.9, 1), ("hot", 5.8, 2), ("hot", 5.7, 3)],
                         key=str)


def test_operators_without_broadcast(spark):
    """The same with broadcast joins disabled."""
    rows = [("hot" if i % 3 else ("a" if i % 2 else None), (i * 7 % 50) / 10 + 1,
             1990 + i % 4) for i in range(300)]
    df = frame(spark, rows)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        w = Window.partitionBy("g").orderBy(F.col("v").desc())
        plain = (df.withColumn("r", F.rank().over(w))
                   .withColumn("d", F.dense_rank().over(Window.orderBy(F.col("v").desc()))))
        fast = global_dense_rank(rank_within(df, ["g"], "v", "r"), "v", "d")
        assert as_set(fast, ["id", "r", "d"]) == as_set(plain, ["id", "r", "d"])
        wy = Window.partitionBy("g").orderBy(F.col("y").asc_nulls_first())
        plain_m = df.withColumn(
            "m", mean_from_sum(F.sum(exact("v")).over(wy), F.count("v").over(wy)))
        fast_m = running_mean_rating(df, "g", ["y"], "v", "m")
        assert as_set(fast_m, ["id", "m"]) == as_set(plain_m, ["id", "m"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@SETTINGS
@given(rows=ROWS)
def test_ranked_in_order_equals_window(spark, rows):
    df = frame(spark, rows)
    w = Window.partitionBy("g").orderBy(F.col("v").desc())
    plain = df.withColumn("r", F.rank().over(w))
    fast = ranked_in_order(df, "g", "v", "id", "r")
    assert as_set(fast, ["id", "g", "v", "r"]) == as_set(plain, ["id", "g", "v", "r"])


def big(spark, n=4000):
    """One hot key with ties, a NULL key, and keys that begin and end anywhere."""
    return frame(spark, [("hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{i % 37:02d}",
                          None if i % 11 == 0 else (i * 7 % 40) / 10, None if i % 13 == 0 else 1990 + i * 31 % 17)
                         for i in range(n)])


def test_ranges_split_keys_and_ties_and_stay_right(spark):
    df = big(spark)
    w = Window.partitionBy("g").orderBy(F.col("v").desc())
    ranked = ranked_in_order(df, "g", "v", "id", "r")
    assert as_set(ranked, ["id", "r"]) == as_set(df.withColumn("r", F.rank().over(w)), ["id", "r"])
    got = [(r["g"] is not None, r["g"], r["r"], r["id"]) for r in ranked.collect()]
    assert got == sorted(got, key=lambda x: (x[0], x[1] or "", x[2], x[3]))  # in order without a sort of its own
    wy = Window.partitionBy("g").orderBy(F.col("y").asc_nulls_first())
    means = running_mean_rating(df, "g", ["y"], "v", "m")
    plain = df.withColumn("m", mean_from_sum(F.sum(exact("v")).over(wy), F.count("v").over(wy)))
    assert as_set(means, ["id", "m"]) == as_set(plain, ["id", "m"])
    wl = Window.partitionBy("g").orderBy(F.col("y").asc_nulls_first(), "id")
    assert as_set(previous_value(df, "g", ["y", "id"], "v", "p"), ["id", "p"]) == \
        as_set(df.withColumn("p", F.lag("v").over(wl)), ["id", "p"])


def test_ranges_are_balanced_and_fixed(spark):
    rows = big(spark).withColumn("down", -F.col("v"))
    cut = ranges.Ranges(rows, ["g", "down", "id"], keys=1)
    sizes = [r["count"] for r in rows.groupBy(cut.number()).count().collect()]
    assert len(sizes) == cut.n == 8 and max(sizes) < 3 * 4000 / 8
    hot = rows.where("g = 'hot'").select(cut.number()).distinct().count()
    assert hot >= 2
    again = rows.repartition(5).select("id", cut.number().alias("n"))
    assert as_set(again, ["id", "n"]) == as_set(rows.select("id", cut.number().alias("n")), ["id", "n"])
    number = {r["id"]: r["n"] for r in again.collect()}
    order = [r["id"] for r in rows.orderBy("g", "down", "id").collect()]
    assert [number[i] for i in order] == sorted(number.values())


def test_one_exchange_after_the_rows_are_stored(spark):
    """The rows of a ranking, a running mean or a lag move once."""
    df = big(spark)
    for fast in (ranked_in_order(df, "g", "v", "id", "r"), running_mean_rating(df, "g", ["y"], "v", "m"),
                 previous_value(df, "g", ["y", "id"], "v", "p")):
        text = fast._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange") == 1 and "Join" not in text, text
        assert text.count("Sort [") == 1 and "FileScan parquet" in text


def test_hot_key_is_split_across_blocks(spark):
    """A key with a third of the rows lands in several range blocks."""
    from marquee.operators.prefix import range_blocks
    n = 3000
    df = spark.createDataFrame(
        [("hot" if i % 3 == 0 else f"k{i % 97}", i) for i in range(n)], "g string, o int")
    blocks = range_blocks(df, [F.col("g").asc_nulls_first(), F.col("o").asc()])
    per_block = {r["_blk"]: r["c"] for r in blocks.where(F.col("g") == "hot")
                 .groupBy("_blk").count().withColumnRenamed("count", "c").collect()}
    assert len(per_block) >= 2
    assert max(per_block.values()) < n // 3


def test_titles_of_a_region_count_once_however_rows_repeat(spark):
    """Repeated titles, lists and genres, null genres and null ratings."""
    from marquee.plans.regions import genres_by_region
    lists = [["x"], ["x", "y"], ["y", "x", "x"], [None, "z", None], [], None, ["z", None]]
    basics = [(f"t{i % 5}" if i % 11 else None, "movie", lists[i % 7]) for i in range(40)]
    basics = spark.createDataFrame(basics, "tconst string, titleType string, genres array<string>")
    akas = spark.createDataFrame([(f"t{i % 6}", ("r", "s", None)[i % 3]) for i in range(25)] + [(None, "r")],
                                 "titleId string, region string")
    ratings = spark.createDataFrame([("t0", 7.5, 2000), ("t1", 3.1, 10), ("t1", 4.0, 5000), ("t2", None, 3000),
                                     ("t3", 9.9, None), (None, 1.0, 4000)],
                                    "tconst string, averageRating double, numVotes int")
    for least in (None, 1000):
        rows = (basics.where("genres is not null").join(ratings, "tconst")
                .join(akas.where("region is not null").withColumnRenamed("titleId", "tconst"), "tconst"))
        if least is not None:
            rows = rows.where(F.col("numVotes") >= least)
        rows = rows.select("*", F.explode("genres").alias("genre"))
        if least is not None:
            rows = rows.where("genre is not null")
        plain = rows.groupBy("region", "genre").agg(
            F.count_distinct("tconst").alias("title_count"),
            mean_from_sum(F.sum(exact("averageRating")), F.count(F.lit(1))).alias("avg_rating"))
        fast = genres_by_region(basics, akas, ratings, min_votes=least)
        cols = ["region", "genre", "title_count", "avg_rating"]
        assert as_set(fast, cols) == as_set(plain, cols) and plain.count()
