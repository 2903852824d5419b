"""Cutting the lineage of derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marquee.session import scratch_path


def materialize(table: DataFrame) -> DataFrame:
    """A derived table that several steps read, as Parquet in the shared
    checkpoint folder: it is computed once, later steps read the columns they
    need, lost executors don't matter, and ``remove_scratch`` removes it."""
    spark = table.sparkSession
    path = scratch_path(spark, "table")
    table.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(table.schema).parquet(path)
