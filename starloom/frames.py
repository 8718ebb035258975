"""Small frames built inside the JVM (no Python-side RDD): empty tables and constant rows.

Both carry exact size statistics, so the planner can broadcast them without guessing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def _literal(v, t: T.DataType) -> str:
    if v is None:
        return f"CAST(NULL AS {t.simpleString()})"
    if isinstance(t, T.StringType):
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(t, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return f"CAST({int(v)} AS {t.simpleString()})"
    if isinstance(t, T.DoubleType):
        return f"CAST('{float(v)!r}' AS DOUBLE)"
    if isinstance(t, T.TimestampType):
        return f"TIMESTAMP '{v:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(t, T.DateType):
        return f"DATE '{v:%Y-%m-%d}'"
    if isinstance(t, T.BooleanType):
        return "TRUE" if v else "FALSE"
    raise TypeError(f"unsupported literal type {t}")


def rows_frame(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    """A ``VALUES`` relation of driver-side rows (meant for small, bounded lists)."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    if not rows:
        return empty_frame(spark, schema)
    fields = schema.fields
    values = ", ".join("(" + ", ".join(_literal(v, f.dataType) for v, f in zip(r, fields)) + ")" for r in rows)
    names = ", ".join(f"`{f.name}`" for f in fields)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")
