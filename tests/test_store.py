"""Bucketed catalogue tables: same answers, title joins without a shuffle."""

import pytest

from marquee.plans import titles
from marquee.sources.star import star_catalogue
from marquee.sources.store import save_catalogue, table_catalogue
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def stored(spark):
    save_catalogue(star_catalogue(spark, SF_SMALL), "marquee_test", buckets=8)
    return table_catalogue(spark, "marquee_test")


def test_same_rows(spark, stored):
    star = star_catalogue(spark, SF_SMALL)
    for t in ("basics", "ratings", "crew", "name"):
        assert sorted(map(str, stored[t].collect())) == sorted(map(str, star[t].collect())), t


def test_title_join_needs_no_shuffle(spark, stored):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = stored.basics.join(stored.ratings, "tconst")
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text
        assert "Exchange" not in text
        got = titles.genre_mean_rating(stored.basics, stored.ratings).collect()
        want = titles.genre_mean_rating(star_catalogue(spark, SF_SMALL).basics,
                                        star_catalogue(spark, SF_SMALL).ratings).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _question_keys():
    from marquee.__main__ import question_keys
    return question_keys()


@pytest.mark.parametrize("key", _question_keys())
def test_same_answers_from_store(spark, stored, key):
    from marquee.plans.registry import QUERIES
    star = star_catalogue(spark, SF_SMALL)
    a = sorted(map(str, QUERIES[key](star).collect()))
    b = sorted(map(str, QUERIES[key](stored).collect()))
    assert a == b, key


@pytest.mark.parametrize("key", ["acclaimed_popular_stored", "genre_mean_rating_stored", "actors_in_acclaimed_stored",
                                 "series_running_mean_stored"])
def test_registered_title_joins_need_no_shuffle(spark, key, monkeypatch):
    """Nothing moves below the joins of titles with their ratings, credits and episodes."""
    import re

    from marquee.operators import series as operators
    from marquee.plans.registry import QUERIES
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    kept = []
    monkeypatch.setattr(operators, "materialize", lambda df: kept.append(df) or df)
    try:
        df = QUERIES[key](star_catalogue(spark, SF_SMALL))
        text = (kept or [df])[0]._jdf.queryExecution().executedPlan().toString()
        joins = [ln for ln in text.splitlines() if re.search(r"(SortMerge|ShuffledHash)Join \[tconst", ln)]
        assert joins, text
        depth = text.splitlines().index(joins[-1])
        below = "\n".join(text.splitlines()[depth:])
        assert "Exchange" not in below.split("FileScan parquet")[0] + below.split("FileScan parquet")[1], below
        assert "Bucketed: true" in below
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
