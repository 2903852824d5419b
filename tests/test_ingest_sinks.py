"""Dump reading (S1..S11) and CSV sinks (K1..K6)."""

import os

import pytest
from pyspark.sql import functions as F

from marquee.plans import titles
from marquee.sinks import csv as sinks
from marquee.sources import tsv
from marquee.sources.schemas import RAW_SCHEMAS
from tests import fixtures

BASICS_TSV = "\n".join([
    "tconst\ttitleType\tprimaryTitle\toriginalTitle\tisAdult\tstartYear\tendYear\truntimeMinutes\tgenres",
    "tt1\tmovie\tPlain\tPlain\t0\t1999\t\\N\t90\tDrama",
    "tt2\tmovie\t\"Unclosed\t\"Unclosed\t1\t\\N\t\\N\t\\N\t\\N",
    "tt3\tshort\tBad year\tBad year\t0\tabc\t\\N\t12\tComedy,Drama,Short",
    "tt4\tshort\tOrder\tOrder\t0\t2001\t\\N\t5\tShort,Drama,Comedy",
]) + "\n"


@pytest.fixture()
def dump_dir(tmp_path):
    folder = tmp_path / "dumps"
    (folder / "title.basics.tsv").mkdir(parents=True)
    (folder / "title.basics.tsv" / "part-0.tsv").write_text(BASICS_TSV, encoding="utf-8")
    return str(folder)


def test_typed_scan_and_shape(spark, dump_dir):
    raw = tsv.read_typed_tsv(spark, tsv.dump_path(dump_dir, "basics"), RAW_SCHEMAS["basics"])
    shaped = {r.tconst: r for r in tsv.shape("basics", raw).collect()}
    assert shaped["tt1"].genres == ["Drama"] and shaped["tt1"].isAdult is False
    assert shaped["tt1"].endYear is None
    # No quote character: the leading quote stays in the title.
    assert shaped["tt2"].primaryTitle == '"Unclosed' and shaped["tt2"].isAdult is True
    assert shaped["tt2"].genres is None and shaped["tt2"].startYear is None
    # A malformed number becomes NULL, the rest of the row is kept.
    assert shaped["tt3"].startYear is None and shaped["tt3"].runtimeMinutes == 12
    assert shaped["tt3"].genres == ["Comedy", "Drama", "Short"]


def test_untyped_scan_keeps_token_until_cleaned(spark, dump_dir):
    raw = tsv.read_untyped_tsv(spark, tsv.dump_path(dump_dir, "basics"))
    assert all(t == "string" for _, t in raw.dtypes)
    row = raw.where(F.col("tconst") == "tt1").first()
    assert row.endYear == "\\N"
    assert tsv.clean_null_token(raw).where(F.col("tconst") == "tt1").first().endYear is None


def test_dump_round_trip_whole_catalogue(spark, tmp_path):
    cat = fixtures.catalogue(spark)
    folder = str(tmp_path / "cat")
    for t in ("basics", "akas", "crew", "episode", "ratings", "principals", "name"):
        tsv.write_dump(cat[t], t, folder)
    back = tsv.load_catalogue(spark, folder)
    for t in ("basics", "akas", "crew", "episode", "ratings", "principals", "name"):
        a = sorted(map(str, cat[t].collect()))
        b = sorted(map(str, back[t].collect()))
        assert a == b, t


def test_export_n_files_and_read_back(spark, tmp_path):
    cat = fixtures.catalogue(spark)
    df = titles.rank_in_genre(cat.basics, cat.ratings)
    path = str(tmp_path / "k2")
    rep = sinks.export_csv_n(df, path, 3)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == 3 and rep.rows == df.count()
    back = sinks.read_back(spark, path, sinks.csv_schema(df))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_export_partitioned_and_missing_column(spark, tmp_path):
    cat = fixtures.catalogue(spark)
    df = titles.rank_in_genre(cat.basics, cat.ratings)
    path = str(tmp_path / "k3")
    sinks.export_csv_partitioned(df, path, "genre")
    dirs = sorted(d for d in os.listdir(path) if d.startswith("genre="))
    assert all(len([f for f in os.listdir(f"{path}/{d}") if f.startswith("part-")]) == 1 for d in dirs)
    assert dirs == ["genre=Action", "genre=Comedy", "genre=Drama", "genre=Romance"]
    # Not a column of the result: plain export.
    other = str(tmp_path / "k3b")
    sinks.export_csv_partitioned(df, other, "nope")
    assert not any(d.startswith("nope=") for d in os.listdir(other))


def test_single_file_sorted_and_no_overwrite(spark, tmp_path):
    cat = fixtures.catalogue(spark)
    df = titles.rank_in_genre(cat.basics, cat.ratings)
    path = str(tmp_path / "k6")
    rep = sinks.export_single_file(df, path, order=[F.col("genre"), F.col("rank_within_genre")])
    assert os.path.isfile(path) and rep.rows == df.count()
    head, *lines = open(path, encoding="utf-8").read().splitlines()
    assert head == ",".join(df.columns)
    keys = [(ln.split(",")[2], int(ln.split(",")[4])) for ln in lines]
    assert keys == sorted(keys) and len(keys) == rep.rows
    before = open(path, "rb").read()
    with pytest.raises(ValueError):
        sinks.export_single_file(df, path)
    assert open(path, "rb").read() == before
    assert [f for f in os.listdir(tmp_path) if "parts" in f] == []  # nothing is left beside it


def test_single_file_of_any_size_runs_the_plan_once(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch
    df = spark.range(200_000).selectExpr("id", "(id * 7919) % 200000 AS r").mapInArrow(seen, "id long, r long")
    rep = sinks.export_single_file(df, str(tmp_path / "one"), parts=7)
    assert rep.rows == 200_000 == runs.value
    ordered = spark.range(50_000).selectExpr("id", "(id * 7919) % 50000 AS r")
    sinks.export_single_file(ordered, str(tmp_path / "sorted"), [F.col("r")], parts=7)
    head, *lines = open(tmp_path / "sorted", encoding="utf-8").read().splitlines()
    assert head == "id,r" and [int(x.split(",")[1]) for x in lines] == list(range(50_000))
    empty = sinks.export_single_file(ordered.limit(0), str(tmp_path / "empty"))
    assert empty.rows == 0 and open(tmp_path / "empty").read() == "id,r\n"


def test_manifest_of_parts_and_first_rows_need_no_second_job(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "array(id) AS list")
    rep = sinks.export_csv_n(df, str(tmp_path / "n"), 4, [F.col("id")])
    files = sorted(f for f in os.listdir(tmp_path / "n") if f.startswith("part-"))
    counted = {int(f[5:10]): len(open(tmp_path / "n" / f).read().splitlines()) - 1 for f in files}
    assert rep.parts == counted and sum(rep.parts.values()) == rep.rows == 1000
    first = sinks.first_rows(df, "numbers", [F.desc("id")], 3)
    assert [tuple(r) for r in first.orderBy("place").collect()] == [
        ("numbers", 1000, 1, 999, "999"), ("numbers", 1000, 2, 998, "998"), ("numbers", 1000, 3, 997, "997")]
    assert sinks.first_rows(df.limit(0), "none", [F.desc("id")]).collect() == []


# --- malformed rows ------------------------------------------------------------


def test_malformed_fields_and_lines_are_kept_aside(spark, tmp_path):
    text = "\n".join(["tconst\taverageRating\tnumVotes", "tt1\t5.5\t10", "tt2\t\\N\t\\N", "tt3\thigh\t7",
                      "tt4\t6.5\tmany", "tt5\t6.5", "tt6\t6.5\t3\t9", "tt7\tx\ty", "tt8\t1e1\t99999999999"]) + "\n"
    (tmp_path / "title.ratings.tsv").write_text(text)
    path = tsv.dump_path(str(tmp_path), "ratings")
    checked = tsv.read_checked_tsv(spark, path, "ratings")
    rows = {r["tconst"]: r for r in checked.collect()}
    assert {k: r[tsv.BAD_FIELDS] for k, r in rows.items()} == {
        "tt1": [], "tt2": [], "tt3": ["averageRating"], "tt4": ["numVotes"], "tt5": [], "tt6": [],
        "tt7": ["averageRating", "numVotes"], "tt8": ["numVotes"]}
    assert {k: r[tsv.BAD_LINE] for k, r in rows.items() if r[tsv.BAD_LINE]} == {
        "tt5": "tt5\t6.5", "tt6": "tt6\t6.5\t3\t9"}
    assert rows["tt3"]["numVotes"] == 7 and rows["tt3"]["averageRating"] is None
    assert sorted(r["tconst"] for r in tsv.well_formed("ratings", checked).collect()) == ["tt1", "tt2"]
    assert tsv.well_formed("ratings", checked).select("tconst").count() == 2  # a torn line shows without its columns
    assert tsv.malformed(checked).count() == 6
    report = {r["column_name"]: (r["n_rows"], r["n_malformed"]) for r in tsv.malformed_report("ratings", checked).collect()}
    assert report == {None: (8, 2), "tconst": (8, 0), "averageRating": (8, 2), "numVotes": (8, 3)}


def test_a_checked_read_of_whole_dumps_is_the_plain_one(spark, tmp_path):
    cat = fixtures.catalogue(spark)
    folder = str(tmp_path)
    for t in ("basics", "episode", "name", "ratings"):
        tsv.write_dump(cat[t], t, folder)
        checked = tsv.read_checked_tsv(spark, tsv.dump_path(folder, t), t)
        assert tsv.malformed(checked).count() == 0
        assert sorted(map(str, tsv.well_formed(t, checked).collect())) == sorted(map(str, tsv.load_table(spark, folder, t).collect()))


def test_arrays_become_strings(spark):
    cat = fixtures.catalogue(spark)
    from marquee.operators.arrays import stringify_arrays
    got = {r.tconst: r.genres for r in stringify_arrays(cat.basics).collect()}
    assert got["tt1"] == "Drama, Comedy" and got["tt4"] == ""


AWKWARD = ["  pad  ", "", None, 'q"uo"te', '"', "back\\slash\\", "a\nb", "a,b", '""', "\\N", "tab\there", " ", "é\r\nz"]


@pytest.mark.parametrize("export", [sinks.export_csv_auto, lambda d, p: sinks.export_csv_n(d, p, 2),
                                    lambda d, p: sinks.export_csv_partitioned(d, p, "part"),
                                    sinks.export_single_file])
def test_text_survives_every_sink(spark, tmp_path, export):
    rows = [(i, t, i % 2) for i, t in enumerate(AWKWARD)]
    df = spark.createDataFrame(rows, "i int, t string, part int")
    assert export(df, str(tmp_path / "x")).rows == len(rows)
    back = sinks.read_back(spark, str(tmp_path / "x"), sinks.csv_schema(df))
    assert sorted(map(tuple, back.select("i", "t", "part").collect())) == rows


def test_files_follow_the_order(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "(id * 7919) % 1000 AS r")
    sinks.export_csv_n(df, str(tmp_path / "n"), 4, [F.col("r")])
    sinks.export_csv_auto(df.orderBy("r"), str(tmp_path / "auto"))
    for name, files in (("n", 4), ("auto", None)):
        parts = sorted(f for f in os.listdir(tmp_path / name) if f.startswith("part-"))
        assert files in (None, len(parts))
        got = [int(ln.split(",")[1]) for f in parts
               for ln in (tmp_path / name / f).read_text().splitlines()[1:]]
        assert got == list(range(1000))


def test_text_in_dumps(spark, tmp_path):
    from marquee.sources.schemas import shaped_schema
    def people(texts):
        return spark.createDataFrame([(f"nm{i}", t, 1950, None, [t] if t else None, []) for i, t in enumerate(texts)],
                                     shaped_schema("name"))
    kept = [t for t in AWKWARD if t is None or not set(t) & set("\t\r\n,")]
    tsv.write_dump(people(kept), "name", str(tmp_path))
    back = tsv.load_table(spark, str(tmp_path), "name").orderBy(F.length("nconst"), "nconst").collect()
    # An empty text, an empty list and the NULL token itself read as NULL.
    plain = [None if t in ("", "\\N") else t for t in kept]
    assert [r.primaryName for r in back] == plain
    assert [r.primaryProfession for r in back] == [t and [t] for t in plain]
    assert {r.knownForTitles for r in back} == {None}
    for bad in ("tab\there", "a\nb"):
        with pytest.raises(Exception, match="tab or line break"):
            tsv.write_dump(people([bad]), "name", str(tmp_path / "bad"))


def test_untyped_scan_has_no_quotes(spark, dump_dir):
    raw = tsv.read_untyped_tsv(spark, tsv.dump_path(dump_dir, "basics"))
    row = raw.where(F.col("tconst") == "tt2").first()
    assert (row.primaryTitle, row.originalTitle, row.isAdult) == ('"Unclosed', '"Unclosed', "1")


def test_batch_run_exports_every_question(spark, tmp_path):
    from marquee.__main__ import question_keys, run
    cat = fixtures.catalogue(spark)
    keys = question_keys()
    assert "recent_top_rated" in keys and "dataset_info" in keys
    assert not any(k.startswith(("shape_", "export_", "scan_")) for k in keys)
    reports = run(cat, str(tmp_path / "out"), ["recent_top_rated", "genre_trend_by_year"])
    assert reports["recent_top_rated"].rows == 3
    assert os.path.isdir(str(tmp_path / "out" / "genre_trend_by_year"))
    options = {"recent_top_rated": {"num_partitions": 2}, "genre_trend_by_year": {"partition_column": "genre"}}
    reports = run(cat, str(tmp_path / "more"), ["no_such_key", *options], options)
    assert isinstance(reports["no_such_key"], KeyError) and reports["recent_top_rated"].rows == 3
    assert any(d.startswith("genre=") for d in os.listdir(tmp_path / "more" / "genre_trend_by_year"))
