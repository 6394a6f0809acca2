"""Result conformance: fixed, engine-neutral output types.

Checked outputs use BIGINT, DOUBLE, BOOLEAN and VARCHAR only: decimals
are summed exactly and converted at the end, dates/timestamps are
rendered as ISO text, arrays as comma-joined text.  The oracle SQL casts
to the same types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.DecimalType, T.FloatType, T.DoubleType)):
            c = c.cast("double")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.ArrayType):
            c = F.concat_ws(",", c.cast("array<string>"))
        elif isinstance(t, (T.StructType, T.MapType)):
            c = F.to_json(c)
        out.append(c.alias(f.name))
    return df.select(*out)
