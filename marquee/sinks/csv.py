"""CSV export of query results (K1..K6).

Every export is a single write job: array columns are stringified first (CSV
has no arrays), and its manifest (the row count and, for an ordered result,
the first rows) is observed in that same job, never counted by another.

Text survives: blanks at its ends, quotes, backslashes and line breaks come
back as written, and an empty text (written as ``""``) differs from NULL
(written as nothing).
"""

from __future__ import annotations

import csv
import io
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators.arrays import stringify_arrays
from marquee.session import remove_path

#: Both sides of a file: a quote inside quotes is doubled, nothing is trimmed.
TEXT = {"header": "true", "quote": '"', "escape": '"',
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
#: NULL is written as nothing and an empty text in quotes; the reader needs
#: some other name for NULL to tell the two apart.
WRITTEN = {**TEXT, "nullValue": "", "emptyValue": '""'}
READ = {**TEXT, "nullValue": "\x00", "emptyValue": "", "multiLine": "true"}
#: Rows that a manifest shows of an ordered result.
SHOWN = 10
#: Files of an export whose rows are counted one by one.
MOST_COUNTED = 1_000


@dataclass
class ExportReport:
    """What an export wrote: its rows, and the rows of each part where the
    number of parts was asked for (part ``i`` is the i-th file in name order;
    a part without rows has no file)."""

    path: str
    rows: int
    parts: dict[int, int] = field(default_factory=dict)


def _write(df: DataFrame, path: str, partition_column: str | None = None,
           mode: str = "overwrite", parts: int = 0, header: bool = True) -> ExportReport:
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    if 0 < parts <= MOST_COUNTED:
        metrics += [F.count_if(F.spark_partition_id() == i).alias(f"part {i}") for i in range(parts)]
    writer = df.observe(seen, *metrics).write.mode(mode).options(**WRITTEN | {"header": str(header).lower()})
    if partition_column:
        writer = writer.partitionBy(partition_column)
    writer.csv(path)
    found = seen.get
    return ExportReport(path, int(found.get("rows", 0)),
                        {i: int(found.get(f"part {i}", 0)) for i in range(parts)} if parts <= MOST_COUNTED else {})


def _ordered(df: DataFrame, order: Sequence[Column] | None, files: int) -> DataFrame:
    """``files`` parts that follow each other in ``order``, or any parts."""
    if not order:
        return df.repartition(files)
    return df.repartitionByRange(files, *order).sortWithinPartitions(*order)


def export_csv_auto(df: DataFrame, path: str) -> ExportReport:
    """K1: as the result comes: a sorted result is already in range parts, whose
    files follow each other, and AQE has sized them."""
    return _write(stringify_arrays(df), path)


def export_csv_n(df: DataFrame, path: str, n: int,
                 order: Sequence[Column] | None = None) -> ExportReport:
    """K2: ``n`` files; with ``order`` they are ranges that follow each other."""
    return _write(_ordered(stringify_arrays(df), order, n), path, parts=n)


def export_csv_partitioned(df: DataFrame, path: str, column: str) -> ExportReport:
    """K3: a folder for each value of ``column``. The rows are rebalanced on it,
    so a value is one file unless it is large enough to be split."""
    if column not in df.columns:
        return export_csv_auto(df, path)
    return _write(stringify_arrays(df).hint("rebalance", F.col(column)), path, column)


def _header(names: Sequence[str]) -> bytes:
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerow(names)
    return out.getvalue().encode()


def _copied(target: str, parts: Sequence[str]):
    """A task's work where the file system can't join files itself: the parts'
    bytes, some at a time, into a new file that appears when it is complete."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            system, name = fs.FileSystem.from_uri(target)
            unfinished = f"{name}.{uuid.uuid4().hex}"
            with system.open_output_stream(unfinished) as out:
                for part in parts:
                    with system.open_input_stream(fs.FileSystem.from_uri(part)[1]) as source:
                        while chunk := source.read(8 << 20):
                            out.write(chunk)
            system.move(unfinished, name)
            yield batch
    return run


def export_single_file(df: DataFrame, path: str, order: Sequence[Column] | None = None,
                       parts: int | None = None) -> ExportReport:
    """K6: one new file ``path`` of any size, in ``order`` if there is one.

    The plan runs once and writes range parts in parallel; the file system
    then joins them, in order and behind a header, without reading them where
    it can (HDFS does), else one task streams them into the file. An existing
    path is refused before anything is written.
    """
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(conf)
    if system.exists(target):
        raise ValueError(f"{path} exists")
    folder = f"{path}.parts-{uuid.uuid4().hex}"
    rows = stringify_arrays(df)
    if order:
        rows = _ordered(rows, order, parts or int(spark.conf.get("spark.sql.shuffle.partitions")))
    try:
        report = _write(rows, folder, mode="errorifexists", header=False)
        head = jvm.org.apache.hadoop.fs.Path(f"{folder}/_head")
        out = system.create(head)
        out.write(bytearray(_header(rows.columns)))
        out.close()
        found = sorted(s.getPath().toUri().toString() for s in system.listStatus(
            jvm.org.apache.hadoop.fs.Path(folder)) if s.getPath().getName().startswith("part-") and s.getLen())
        try:
            listed = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(found))
            for i, name in enumerate(found):
                listed[i] = jvm.org.apache.hadoop.fs.Path(name)
            if found:
                system.concat(head, listed)
            system.rename(head, target)
        except UnsupportedOperationException:
            uri = system.makeQualified(target).toUri().toString()
            named = [system.makeQualified(jvm.org.apache.hadoop.fs.Path(n)).toUri().toString()
                     for n in [head.toUri().toString(), *found]]
            spark.range(1, numPartitions=1).mapInArrow(_copied(uri, named), "id long").collect()
    finally:
        remove_path(spark, folder)
    return ExportReport(path, report.rows)


def export_csv(df: DataFrame, path: str, *, partition_column: str | None = None,
               num_partitions: int | None = None,
               order: Sequence[Column] | None = None) -> ExportReport:
    """The batch run's choice: by column, into a number of files, or as it comes."""
    if partition_column:
        return export_csv_partitioned(df, path, partition_column)
    if num_partitions:
        return export_csv_n(df, path, num_partitions, order)
    return export_csv_auto(df, path)


def result_stats(df: DataFrame, title: str) -> DataFrame:
    """K5: (title, n_rows) of a result, computed by Spark as a DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(title).alias("title"), "n_rows")


def first_rows(df: DataFrame, title: str, order: Sequence[Column], shown: int = SHOWN) -> DataFrame:
    """K5: the first ``shown`` rows of a result in ``order`` (a display limit),
    each with the result's title, its number of rows and its place.

    The result is computed once: its rows are counted while the first ones are
    picked, of which no more than ``shown`` leave a task. No rows, no row.
    """
    seen = Observation()
    text = stringify_arrays(df)
    first = text.observe(seen, F.count(F.lit(1)).alias("rows")).orderBy(*order).limit(shown).collect()
    n = int(seen.get["rows"])
    schema = T.StructType([T.StructField("title", T.StringType()), T.StructField("n_rows", T.LongType()),
                           T.StructField("place", T.IntegerType()), *text.schema.fields])
    return df.sparkSession.createDataFrame([(title, n, i, *r) for i, r in enumerate(first, 1)], schema)


def csv_schema(df: DataFrame) -> T.StructType:
    """Schema of ``df`` as exported: arrays become strings."""
    return T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.ArrayType)
                      else f.dataType, True) for f in df.schema.fields])


def read_back(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(**READ).csv(path)
