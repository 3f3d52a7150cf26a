"""Result shape that two engines share: no decimals, no timestamps, no nesting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.functions.numeric import micros


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double, timestamps as microseconds, arrays joined by ``|``."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = micros(c)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, "|")
        out.append(c.alias(f.name))
    return df.select(*out)
