"""Batch run: load a catalogue, answer every question, export each as CSV.

    python -m marquee --dumps DIR --out DIR      # the seven .tsv dumps
    python -m marquee --star DIR --out DIR       # the star-schema Parquet tables
    ... --partition genre_trend_by_year=genre --files best_decade=4

The session is taken from the environment (``getOrCreate``): on a cluster it
is the cluster's, with its memory, partitions and checkpoint folder. Each
result is written once (row count observed in the write job).
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Iterable

from pyspark.sql import SparkSession

from marquee.plans.registry import QUERIES
from marquee.sinks.csv import ExportReport, export_csv
from marquee.sources.catalogue import Catalogue

# Round trips of the ingest and sink operators are checks, not questions.
_ROUND_TRIPS = ("scan_", "shape_", "export_", "clean_null_token", "load_catalogue",
                "stringify_arrays", "result_", "malformed_fields", "load_well_formed")


def question_keys() -> list[str]:
    return [k for k in QUERIES if not k.startswith(_ROUND_TRIPS) and not k.endswith("_stored")]


def run(cat: Catalogue, out_dir: str, keys: Iterable[str] | None = None,
        options: dict[str, dict] | None = None) -> dict[str, ExportReport | Exception]:
    """Answer ``keys`` (default: every question and profile) into ``out_dir``.

    ``options`` has a key's export options (``partition_column``,
    ``num_partitions``). A key that fails is reported with its error, and the
    others go on.
    """
    reports: dict[str, ExportReport | Exception] = {}
    for key in (list(keys) if keys is not None else question_keys()):
        try:
            reports[key] = export_csv(QUERIES[key](cat), f"{out_dir.rstrip('/')}/{key}",
                                      **(options or {}).get(key, {}))
        except Exception as failed:  # noqa: BLE001  the report names it
            reports[key] = failed
    return reports


def _pairs(given: list[str] | None, option: str, kind=str) -> dict[str, dict]:
    return {k: {option: kind(v)} for k, _, v in (g.partition("=") for g in given or ())}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="marquee")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--dumps", help="folder with the seven tab-separated dumps")
    src.add_argument("--star", help="folder with the star-schema Parquet tables")
    ap.add_argument("--out", required=True, help="folder for one CSV folder per question")
    ap.add_argument("--keys", nargs="*", help="questions to answer (default: all)")
    ap.add_argument("--partition", nargs="*", help="KEY=COLUMN: a folder for each value of the column")
    ap.add_argument("--files", nargs="*", help="KEY=N: that many files")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("marquee").getOrCreate()
    if args.dumps:
        from marquee.sources.tsv import load_catalogue
        cat = load_catalogue(spark, args.dumps)
    else:
        from marquee.sources.star import star_catalogue
        cat = star_catalogue(spark, args.star)
    options = _pairs(args.partition, "partition_column") | _pairs(args.files, "num_partitions", int)
    reports = run(cat, args.out, args.keys, options)
    failed = {k: str(r)[:300] for k, r in reports.items() if isinstance(r, Exception)}
    print(json.dumps({k: {"error": failed[k]} if k in failed else {"path": r.path, "rows": r.rows}
                      for k, r in reports.items()}))
    if failed:
        raise SystemExit(1)


if __name__ == "__main__":
    main()
