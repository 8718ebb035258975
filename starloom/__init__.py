"""starloom: a star-schema e-commerce pipeline expressed as Spark DataFrame functions.

Sources (CSV, JSON documents, JDBC, Parquet) are read as strings, cleaned with built-in
column expressions, joined into order lines, and loaded into a star schema (overwrite-in-place
dimensions with stable surrogate keys, insert-once facts) guarded by a data-quality gate.
Every step takes and returns ``DataFrame`` objects so Catalyst plans the whole chain.
"""

from starloom.params import Params

__all__ = ["Params"]
