"""Pure ``Column -> Column`` helpers built from Spark's built-in functions (no Python UDFs)."""

from starloom.functions.dates import date_key, dim_date_columns
from starloom.functions.parse import lenient_double, lenient_int, lenient_timestamp
from starloom.functions.shapes import TimeShape, infer_time_shapes, shape_timestamp, time_shape
from starloom.functions.text import NA_TOKENS, na_to_null, strip_ws, title_case, zfill

__all__ = [
    "NA_TOKENS",
    "TimeShape",
    "date_key",
    "dim_date_columns",
    "infer_time_shapes",
    "lenient_double",
    "lenient_int",
    "lenient_timestamp",
    "na_to_null",
    "shape_timestamp",
    "strip_ws",
    "time_shape",
    "title_case",
    "zfill",
]
