"""Physical plan checks: JVM-only, pruned scans, partial top-k, no global window.

The plans are whole: checkpoints are left out while these tests build them, so
every scan shows, and broadcasts are off, as they are for large tables.
"""

import re

import pytest

from marquee.operators import prefix, rank, series
from marquee.plans import people, titles
from marquee.plans.registry import QUERIES
from marquee.sources.star import star_catalogue
from tests.conftest import SF_SMALL

# Round-trip keys write files when built; their plans are covered elsewhere.
ROUND_TRIPS = {k for k in QUERIES if k.startswith(("scan_", "shape_", "export_"))} | {
    "clean_null_token", "load_catalogue"}
PLANNED = sorted(k for k in QUERIES if k not in ROUND_TRIPS)
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF", "MapInArrow")


@pytest.fixture(scope="module")
def cat(spark):
    patch = pytest.MonkeyPatch()
    for module in (prefix, people, titles, rank, series):
        patch.setattr(module, "materialize", lambda table: table)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield star_catalogue(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    patch.undo()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", PLANNED)
def test_no_python_in_plan(cat, key):
    text = plan(QUERIES[key](cat))
    assert not any(n in text for n in PYTHON_NODES), key


@pytest.mark.parametrize("key", ["top3_series_per_region", "top5_directors_per_genre",
                                 "longest_per_genre", "best_decade", "recent_genre_counts"])
def test_top_k_per_group_is_partial(cat, key):
    text = plan(QUERIES[key](cat))
    # One WindowGroupLimit before the shuffle (partial) and one after (final).
    assert text.count("WindowGroupLimit") >= 2, key


@pytest.mark.parametrize("key", PLANNED)
def test_single_partition_only_over_bounded_input(cat, key):
    """A single-partition exchange may only gather a partial global aggregate
    (one row per task), a partial limit, or block totals (a row per range block)."""
    lines = plan(QUERIES[key](cat)).splitlines()
    for i, ln in enumerate(lines):
        if "Exchange SinglePartition" in ln:
            below = lines[i + 1] if i + 1 < len(lines) else ""
            ok = ("partial_" in below and "keys=[]" in below.replace("key=[]", "keys=[]")) \
                or "LocalLimit" in below or "keys=[_blk" in below
            assert ok, (key, below)


def tree(text: str) -> list[tuple[str, list[str]]]:
    """(node, nodes above it) of a plan."""
    out, above = [], []
    for line in text.splitlines():
        found = re.search(r"[A-Za-z(*]", line)
        if not found:
            continue
        above = [(d, n) for d, n in above if d < found.start()]
        node = line[found.start():]
        out.append((node, [n for _, n in above]))
        above.append((found.start(), node))
    return out


JOIN = re.compile(r"(\*\(\d+\) )?SortMergeJoin \[tconst")


@pytest.mark.parametrize("key", ["genre_popularity", "genre_mean_rating", "genre_trend_by_year", "rank_in_genre",
                                 "actors_by_genre", "top5_directors_per_genre", "genres_by_region"])
def test_genres_are_exploded_after_the_title_joins(cat, key):
    nodes = tree(plan(QUERIES[key](cat)))
    lists = [above for node, above in nodes if "Generate explode(genres" in node]
    assert lists and not any(JOIN.match(n) for above in lists for n in above), key


@pytest.mark.parametrize("key", ["games_per_director", "titles_of_person", "best_decade", "best_decade_multi",
                                 "genre_directors", "actor_directors", "versatile_directors",
                                 "versatile_game_directors", "director_leaderboard"])
def test_crew_is_never_listed_and_exploded(cat, key):
    text = plan(QUERIES[key](cat))
    assert "collect_set(CASE" not in text and "explode(directors" not in text, key


@pytest.mark.parametrize("key", ["actors_by_genre", "top5_directors_per_genre", "actors_in_best_episodes"])
def test_names_are_joined_to_aggregated_ids(cat, key):
    nodes = tree(plan(QUERIES[key](cat)))
    scans = [above for node, above in nodes if "lineitem.parquet" in node and "l_returnflag" in node
             and "l_quantity" not in node]
    name_join = re.compile(r"(\*\(\d+\) )?SortMergeJoin \[nconst")
    assert scans
    for above in scans:
        at = [i for i, n in enumerate(above) if name_join.match(n)]
        assert at and any("HashAggregate(keys=" in n and "nconst" in n for n in above[at[-1]:]), key


def test_one_series_is_split_by_position(cat):
    """Rows move once, by the number of their range of (series, position)."""
    nodes = tree(plan(QUERIES["series_running_mean_by_parent"](cat)))
    dealt = [above for n, above in nodes if "Exchange" in n and "_range" in n]
    assert len(dealt) == 1 and not any(JOIN.match(n) for n in dealt[0])


def test_title_keyword_reads_titles_once(cat):
    text = plan(QUERIES["title_keyword"](cat))
    assert text.count("orders.parquet") == 1


def test_scan_prunes_columns(cat):
    text = plan(QUERIES["recent_top_rated"](cat))
    # Titles need only key and customer; ratings only order and price.
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in text


# Column counts of the driver's large tables; nation and region are tiny
# and fully used by the localised-title binding.
WIDE = {"lineitem": 11, "orders": 6, "customer": 5, "part": 6, "supplier": 4}


@pytest.mark.parametrize("key", PLANNED)
def test_scans_read_only_needed_columns(cat, key):
    text = plan(QUERIES[key](cat))
    for m in re.finditer(r"Location: InMemoryFileIndex\(1 paths\)\[[^\]]*/(\w+)\.parquet\].*?"
                         r"ReadSchema: struct<([^>\n]*)", text):
        table, fields = m.group(1), m.group(2).split(",")
        if table in WIDE and key != "column_info":  # that one counts every column
            assert len(fields) < WIDE[table], (key, table, fields)


@pytest.mark.parametrize("key", ["genres_by_region", "genres_by_region_min_votes"])
def test_regions_hold_no_table_of_titles(cat, key):
    """Distinct titles of a (region, genre) are counted without one row each."""
    grouped = [n for n, _ in tree(plan(QUERIES[key](cat))) if "Aggregate(keys=[" in n and "genre#" in n]
    assert grouped and not any("tconst" in n.split("functions=")[0] for n in grouped)
