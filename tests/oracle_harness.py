"""Compare a Spark query with its DuckDB oracle: row count, column names and an
order-insensitive multiset of normalised rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


# Spark type -> the kind of DuckDB type that must stand beside it.
KINDS = {
    "boolean": "bool", "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "float": "float", "double": "float",
    "string": "text", "date": "date", "timestamp": "time", "timestamp_ntz": "time",
}
DUCK_KINDS = {
    "BOOLEAN": "bool", "TINYINT": "int", "SMALLINT": "int", "INTEGER": "int", "BIGINT": "int", "HUGEINT": "int", "UBIGINT": "int",
    "FLOAT": "float", "DOUBLE": "float", "VARCHAR": "text", "DATE": "date", "TIMESTAMP": "time",
}


def kind(spark_type: str) -> str:
    return "float" if spark_type.startswith("decimal") else KINDS.get(spark_type, spark_type)


def duck_kind(duck_type: str) -> str:
    return "float" if duck_type.startswith("DECIMAL") else DUCK_KINDS.get(duck_type, duck_type)


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def nanoseconds(v: dt.datetime | None) -> int | None:
    if v is None:
        return None
    since = v.replace(tzinfo=None) - dt.datetime(1970, 1, 1)
    return ((since.days * 86400 + since.seconds) * 10**6 + since.microseconds) * 1000


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols, d_types = rel.columns, dict(zip(rel.columns, map(str, rel.types)))
    own = {c: (kind(t), duck_kind(d_types[c])) for c, t in spark_df.dtypes if c in d_types}
    wrong = {c: (dict(spark_df.dtypes)[c], d_types[c]) for c, (a, b) in own.items() if a != b and '"NULL"' != d_types[c]}
    if wrong:
        return False, f"types differ: {wrong}"
    # Times to the nanosecond: Python's datetime would cut them.
    times = [c for c, (a, _) in own.items() if a == "time"]
    if times:
        rel = con.sql(f"SELECT * REPLACE ({', '.join(f'epoch_ns({c}) AS {c}' for c in times)}) FROM ({sql})")
    d_rows = rel.fetchall()
    s_times = [i for i, c in enumerate(s_cols) if c in times]
    if s_times:
        s_rows = [tuple(nanoseconds(v) if i in s_times else v for i, v in enumerate(r)) for r in s_rows]
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sc = Counter(tuple(norm(r[i]) for i in si) for r in s_rows)
    dc = Counter(tuple(norm(r[i]) for i in di) for r in d_rows)
    if len(s_rows) != len(d_rows):
        diff = list((sc - dc).items())[:3], list((dc - sc).items())[:3]
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}; only spark/duck: {diff}"
    if sc != dc:
        return False, f"values differ; only spark: {list((sc - dc).items())[:3]} only duck: {list((dc - sc).items())[:3]}"
    return True, f"{len(s_rows)} rows"
