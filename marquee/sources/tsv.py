"""Ingest of the tab-separated title/name dumps (S1..S11), and their writer.

Reading is a plain CSV scan with an explicit schema: tab separator, a header
line, ``\\N`` as the NULL token, no quote character (the dumps are unquoted,
so a title starting with ``"`` is kept as written, and blanks at a text's ends
stay). The layout has no way to write an empty text, an empty list, or a text
that is the NULL token: they read as NULL. It has none for tabs and line
breaks either: the writer refuses rows that hold them. Shaping then splits the
comma lists into arrays and parses the 0/1 flags. Everything is a projection
over the scan, so it is lazy and splits like any text input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.sources.catalogue import TABLES, Catalogue
from marquee.sources.schemas import (FILE_STEMS, FLAG_COLUMNS, LIST_COLUMNS, LIST_SEPARATOR,
                                     NULL_TOKEN, RAW_SCHEMAS)

LAYOUT = {"sep": "\t", "header": "true", "quote": "", "ignoreLeadingWhiteSpace": "false",
          "ignoreTrailingWhiteSpace": "false"}
TSV_OPTIONS = {**LAYOUT, "nullValue": NULL_TOKEN, "mode": "PERMISSIVE"}


def read_typed_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S1: a header TSV with the ``\\N`` NULL token and a fixed schema.

    Malformed numbers become NULL (permissive parsing).
    """
    return spark.read.schema(schema).options(**TSV_OPTIONS).csv(path)


def read_untyped_tsv(spark: SparkSession, path: str) -> DataFrame:
    """S2: a header TSV with every column a string, no NULL token handling."""
    return spark.read.options(**LAYOUT).csv(path)


def clean_null_token(df: DataFrame, token: str = NULL_TOKEN) -> DataFrame:
    """S3: the NULL token in any string column becomes NULL (arrays untouched)."""
    return df.select(*[
        F.nullif(F.col(f.name), F.lit(token)).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields])


def _split_list(c: str) -> F.Column:
    return F.split(F.col(c), LIST_SEPARATOR)


def _flag(c: str) -> F.Column:
    # '0'/'1' as in the dumps; 'true'/'false' also parse; anything else is NULL.
    return F.col(c).try_cast("boolean")


def shape(table: str, df: DataFrame) -> DataFrame:
    """S4..S10: NULL token cleaning, comma lists to arrays, flags to booleans."""
    df = clean_null_token(df)
    lists, flags = set(LIST_COLUMNS[table]), set(FLAG_COLUMNS.get(table, ()))
    return df.select(*[
        _split_list(c).alias(c) if c in lists else _flag(c).alias(c) if c in flags else F.col(c)
        for c in df.columns])


def dump_path(folder: str, table: str, suffix: str = ".tsv") -> str:
    return f"{folder.rstrip('/')}/{FILE_STEMS[table]}{suffix}"


def load_table(spark: SparkSession, folder: str, table: str, suffix: str = ".tsv") -> DataFrame:
    return shape(table, read_typed_tsv(spark, dump_path(folder, table, suffix),
                                       RAW_SCHEMAS[table]))


def load_catalogue(spark: SparkSession, folder: str, suffix: str = ".tsv") -> Catalogue:
    """S11: the seven dumps of a folder as a (lazy) catalogue."""
    return Catalogue({t: (lambda t=t: load_table(spark, folder, t, suffix)) for t in TABLES})


def _one_line(c: F.Column) -> F.Column:
    return F.when(c.rlike("[\t\n\r]"), F.raise_error(F.concat(
        F.lit("tab or line break in a dump field: "), c))).otherwise(c)


def to_dump_layout(table: str, df: DataFrame) -> DataFrame:
    """A shaped table back in dump layout: lists comma-joined, flags as 0/1."""
    lists, flags = set(LIST_COLUMNS[table]), set(FLAG_COLUMNS.get(table, ()))
    cols = []
    for f in RAW_SCHEMAS[table].fields:
        c = f.name
        if c in lists:
            text = F.when(F.col(c).isNotNull(), F.concat_ws(LIST_SEPARATOR, F.col(c)))
            cols.append(_one_line(text).alias(c))
        elif c in flags:
            cols.append(F.when(F.col(c), "1").when(~F.col(c), "0").alias(c))
        elif isinstance(f.dataType, T.StringType):
            cols.append(_one_line(F.col(c)).alias(c))
        else:
            cols.append(F.col(c).cast(f.dataType).alias(c))
    return df.select(*cols)


# --- malformed rows ----------------------------------------------------------

#: Columns that a checked read adds: names of the fields that don't parse, and
#: the line as it came if it has too few or too many fields.
BAD_FIELDS, BAD_LINE = "_bad_fields", "_bad_line"


def read_checked_tsv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """S1: a dump read with a channel for what is malformed.

    The raw columns of ``table`` are typed as :func:`read_typed_tsv` types
    them; in addition every row names its fields that hold a value their type
    can't (they read as NULL), and a line with too few or too many fields is
    kept as it came. No row is dropped, and it is still one scan.
    """
    schema = RAW_SCHEMAS[table]
    flags = set(FLAG_COLUMNS.get(table, ()))
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]
                        + [T.StructField(BAD_LINE, T.StringType())])
    rows = (spark.read.schema(text).options(**TSV_OPTIONS)
            .option("columnNameOfCorruptRecord", BAD_LINE)
            .option("columnPruning", "false").csv(path))  # a torn line shows only in whole lines
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    checked = {c: F.col(c).try_cast("boolean") if c in flags else e for c, e in typed.items()}
    bad = [F.when(F.col(c).isNotNull() & e.isNull(), F.lit(c)) for c, e in checked.items()]
    return rows.select(*[e.alias(c) for c, e in typed.items()], F.col(BAD_LINE),
                       F.filter(F.array(*bad), lambda x: x.isNotNull()).alias(BAD_FIELDS))


def malformed_report(table: str, checked: DataFrame) -> DataFrame:
    """(table_name, column_name, n_rows, n_malformed) of every column of a
    checked read, and a row without a column name for torn lines: one
    partial aggregate."""
    names = [f.name for f in RAW_SCHEMAS[table].fields]
    counts = checked.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(BAD_LINE).alias("torn"),
        *[F.count_if(F.array_contains(BAD_FIELDS, c)).alias(f"bad {c}") for c in names])
    cells = F.array(F.struct(F.lit(None).cast("string").alias("column_name"), F.col("torn").alias("n_malformed")),
                    *[F.struct(F.lit(c).alias("column_name"), F.col(f"bad {c}").alias("n_malformed")) for c in names])
    return (counts.select(F.lit(table).alias("table_name"), "n_rows", F.inline(cells))
            .select("table_name", "column_name", "n_rows", "n_malformed"))


def well_formed(table: str, checked: DataFrame) -> DataFrame:
    """The rows of a checked read that parse whole, shaped."""
    kept = checked.where(F.col(BAD_LINE).isNull() & (F.size(BAD_FIELDS) == 0))
    return shape(table, kept.drop(BAD_LINE, BAD_FIELDS))


def malformed(checked: DataFrame) -> DataFrame:
    """The other rows, with their channel's columns, to be kept aside."""
    return checked.where(F.col(BAD_LINE).isNotNull() | (F.size(BAD_FIELDS) > 0))


def write_lines(df: DataFrame, path: str) -> None:
    """Write text columns as a dump's lines, as they are: a tab inside a field
    tears its line."""
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_TOKEN)) for c in df.columns])
    (df.select(line.alias("\t".join(df.columns))).write.mode("overwrite")
     .options(**LAYOUT | {"sep": "\x01"}, emptyValue="", escapeQuotes="false").csv(path))


def write_dump(df: DataFrame, table: str, folder: str, suffix: str = ".tsv") -> str:
    """Write a shaped table as a dump file folder (header, tabs, ``\\N``)."""
    path = dump_path(folder, table, suffix)
    (to_dump_layout(table, df).write.mode("overwrite")
     .options(**LAYOUT, nullValue=NULL_TOKEN, emptyValue="", escapeQuotes="false")
     .csv(path))
    return path
