"""Array (many-valued attribute) operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.exprs import stringify


def stringify_arrays(df: DataFrame, sep: str = ", ") -> DataFrame:
    """Every array column as a ``sep``-joined string (CSV cannot hold arrays)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            cols.append(stringify(f.name, sep).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
