"""CSV sources: every column arrives as a string; types are applied explicitly later.

No schema inference (an extra pass that also strips leading zeros from ids and zip codes).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.text import na_to_null
from starloom.schemas import REQUIRED_COLUMNS
from starloom.session import COMPACT

ORD = "_ord"


def check_columns(df: DataFrame, expected: Sequence[str], name: str) -> DataFrame:
    """Raise ``ValueError`` listing the missing and the found columns; extra columns pass."""
    missing = sorted(set(expected) - set(df.columns))
    if missing:
        # Fixed text.
        raise ValueError(f"[{name}] Missing expected columns: {missing}. Found: {list(df.columns)}")
    return df


def normalize_na(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn missing-value markers (``NA``, ``null``, ``N/A``, empty, ...) into null in string columns."""
    targets = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
    }
    return df.select(*[na_to_null(F.col(c)).alias(c) if c in targets else F.col(c) for c in df.columns])


def with_ingest_order(df: DataFrame, name: str = ORD) -> DataFrame:
    """Add the input-order ordinal ``(file path, split start, row id)``.

    CSV has no row index. Within one file split the id increases with the row; the split start
    orders splits of one file regardless of how they were packed into tasks. Persist the result
    (``land_raw``) so later steps see the same values.
    """
    return df.withColumn(
        name,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def read_csv(
    spark: SparkSession,
    path: str,
    name: str | None = None,
    required: Sequence[str] | None = None,
    multi_line: bool = False,
    ordinal: bool = True,
) -> DataFrame:
    """Header CSV as strings with missing markers normalised, required columns checked.

    ``escape='"'`` reads doubled quotes inside quoted fields; ``multi_line`` only when fields hold
    newlines (a multi-line file is read by one task).
    """
    label = name or path
    try:
        df = spark.read.csv(path, header=True, escape='"', multiLine=multi_line, inferSchema=False)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(f"Source file not found for {label}: {path}") from exc
        raise
    check_columns(df, required or REQUIRED_COLUMNS.get(name or "", ()), label)
    df = normalize_na(df)
    return with_ingest_order(df) if ordinal else df


def land_raw(
    dfs: Mapping[str, DataFrame],
    raw_root: str,
    counts: dict[str, int] | None = None,
    clustered: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, str]:
    """Write each raw frame (ordinal included) to ``raw_root/<name>`` as Parquet, overwriting.

    When ``counts`` is given, the rows written per source are recorded into it (an observation on
    the write itself, no second pass). Frames named in ``clustered`` are landed sorted by its columns
    (:mod:`starloom.sources.layout`); their rows are counted by the files' footers.
    """
    from starloom.operators.counters import observed
    from starloom.sources.layout import write_clustered

    out = {}
    for name, df in dfs.items():
        path = f"{raw_root}/{name}"
        if clustered and name in clustered:
            out[name] = write_clustered(df, path, clustered[name])
            if counts is not None:
                counts[name] = df.sparkSession.read.parquet(path).count()
            continue
        df_obs, obs = observed(df, f"raw_{name}")
        df_obs.write.mode("overwrite").parquet(path, compression=COMPACT)
        if counts is not None:
            counts[name] = int(obs.get["rows"])
        out[name] = path
    return out
