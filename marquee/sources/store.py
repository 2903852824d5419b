"""Store the catalogue once as bucketed tables, and read it back.

At scale the catalogue is loaded from the dumps once and written as Parquet
tables bucketed (and sorted) by their title or person id. Every title join
(titles, ratings, crew, episodes, credits, localised titles) then reads both
sides already hash-partitioned on the key, so the sort-merge join needs no
shuffle. Tables go to the session's catalog and warehouse, which on a cluster
is shared storage owned by the cluster.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

from marquee.session import scratch_path
from marquee.sources.catalogue import TABLES, Catalogue

# Bucket column per table: the key most joins use.
BUCKET_KEYS = {
    "basics": "tconst", "ratings": "tconst", "crew": "tconst", "episode": "tconst",
    "principals": "tconst", "akas": "titleId", "name": "nconst",
}


def save_catalogue(cat: Catalogue, database: str, *, buckets: int,
                   mode: str = "overwrite", fmt: str = "parquet", tables: Sequence[str] = TABLES,
                   location: str | None = None) -> list[str]:
    """Write ``tables`` as ``database.table`` bucketed by their id; returns names.

    Use the same ``buckets`` for all tables (and ideally the session's
    shuffle partition count) so bucketed joins line up. Rows are dealt out by
    the id first, so that a bucket is one sorted file, whose order a
    sort-merge join then needs no more than its partitioning. ``location`` is
    a folder for the files, if it isn't to be the warehouse.
    """
    spark = cat[tables[0]].sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for t in tables:
        key = BUCKET_KEYS[t]
        name = f"{database}.{t}"
        writer = cat[t].repartition(buckets, key).write.mode(mode).format(fmt).bucketBy(buckets, key).sortBy(key)
        if location:
            writer = writer.option("path", f"{location.rstrip('/')}/{t}")
        writer.saveAsTable(name)
        names.append(name)
    return names


def stored(cat: Catalogue, tables: Sequence[str]) -> Catalogue:
    """``cat`` with ``tables`` read from a bucketed copy in a fresh folder below
    the shared checkpoint folder (``remove_scratch`` removes the files)."""
    spark = cat[tables[0]].sparkSession
    database = f"marquee_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    save_catalogue(cat, database, buckets=buckets, tables=tables, location=scratch_path(spark, "store"))
    copies = {t: (lambda t=t: spark.table(f"{database}.{t}")) for t in tables}
    return Catalogue({t: copies.get(t) or (lambda t=t: cat[t]) for t in TABLES})


def table_catalogue(spark: SparkSession, database: str) -> Catalogue:
    """The catalogue over stored tables (lazy, one table per entry)."""
    return Catalogue({t: (lambda t=t: spark.table(f"{database}.{t}")) for t in TABLES})
