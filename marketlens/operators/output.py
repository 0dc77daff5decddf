"""Result typing at the API boundary: integers as BIGINT; for queries, fractions as DOUBLE.

The library returns exact DECIMAL money (a sum over very many rows has more
digits than a DOUBLE holds). Only the registered queries, which are compared
with another engine, convert to DOUBLE, after rounding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def finalize(df: DataFrame, doubles: bool = False) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif doubles and isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)
