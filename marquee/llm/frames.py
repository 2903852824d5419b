"""Reading, writing and grouping helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import remove_path, remove_scratch, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: the lineage
    ends there, so a lost executor never means computing ``df`` again."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


drop, release = remove_path, remove_scratch


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(column: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``."""
    return F.crc32(column.cast("string").cast("binary")) % folds


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Fewer rows to an Arrow batch, as one row may hold a long text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of equal ``key`` in batches that are sorted by it."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key)
        changes = pc.indices_nonzero(pc.not_equal(keys[1:], keys[:-1])).to_pylist()
        edges = [0, *(c + 1 for c in changes), batch.num_rows]
        for start, end in zip(edges[:-1], edges[1:]):
            first = keys[start].as_py()
            if held and first != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = first
    if held:
        yield pa.Table.from_batches(held)
