"""Surrogate keys: unique, stable for existing rows, larger for new rows.

``row_number().over(Window.orderBy(k))`` would pull every new row into one task. Two ways instead:

* :func:`assign_surrogate_keys` (dimensions): dense ranks in key order. Rows are sorted by Spark over
  range partitions, each row's partition and position are written to the reliable checkpoint folder,
  so they can no longer change, and per-partition counts become offsets.
* :func:`assign_strided_keys` (facts): no order, no extra pass. Rows stay in the hash partitions that
  removing duplicates has made; the k-th row of partition p gets ``start + 1 + p + k * partitions``.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import cut_lineage

_PID, _MID = "_sk_pid", "_sk_mid"


def max_key(df: DataFrame, key: str) -> int:
    """Largest existing surrogate key (0 for an empty table): one scalar to the driver."""
    row = df.agg(F.max(key).alias("m")).first()
    return int(row["m"]) if row is not None and row["m"] is not None else 0


def _position(part: Column, row: Column) -> Column:
    """The row's place within its partition, from ``monotonically_increasing_id``."""
    return row - F.shiftleft(part.cast("long"), 33)


def partition_position() -> Column:
    """The row's place within its task's partition, from 0."""
    return _position(F.spark_partition_id(), F.monotonically_increasing_id())


def assign_surrogate_keys(
    df: DataFrame, key: str, order: Sequence[str | Column], start: int = 0, stored: bool = False
) -> DataFrame:
    """Add ``key = start + rank`` where rank is 1..n over ``order`` (a total order over the rows).

    The rows are read by the range sampler and by the sort; unless they come from a written table
    (``stored``) they are written first.
    """
    spark = df.sparkSession
    cols = list(df.columns)
    src = df if stored else cut_lineage(df, label="unkeyed")
    ranked = cut_lineage(
        src.sort(*order)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_MID, F.monotonically_increasing_id()),
        label="keys",
    )
    # Partition id and position are stored columns, so re-reading may split the files any way.
    counts = sorted((r[_PID], r["n"]) for r in ranked.groupBy(_PID).agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, running = [], start
    for _, n in counts:
        offsets.append(running)
        running += n
    # One row of two numbers per non-empty sort partition, as a local relation.
    table = pa.table({_PID: pa.array([p for p, _ in counts], pa.int32()), "_sk_off": pa.array(offsets, pa.int64())})
    offset_df = spark.createDataFrame(table)
    position = _position(F.col(_PID), F.col(_MID))
    return ranked.join(F.broadcast(offset_df), _PID, "inner").select(
        (F.col("_sk_off") + position + F.lit(1)).cast("long").alias(key), *[F.col(c) for c in cols]
    )


def assign_strided_keys(
    df: DataFrame, key: str, by: Sequence[str], partitions: int, start: int = 0, placed_by: Sequence[str] | None = None
) -> DataFrame:
    """Add a unique ``key`` above ``start`` to rows that are unique by ``by``.

    The hash partitioning by ``by`` (or those of them in ``placed_by``) is that of an earlier
    ``repartition(partitions, *by)``, where there is one, and costs nothing then. Within a partition rows are sorted by ``by``, so
    computing the frame again gives the same keys.
    """
    placed = df.repartition(partitions, *(placed_by or by)).sortWithinPartitions(*by)
    part = F.spark_partition_id()
    position = _position(part, F.monotonically_increasing_id())
    return placed.select(
        (F.lit(start + 1) + part + position * F.lit(partitions)).cast("long").alias(key), *[F.col(c) for c in df.columns]
    )


def assign_small_keys(df: DataFrame, key: str, order: Sequence[str | Column], start: int = 0) -> DataFrame:
    """Dense ranks for inputs with a fixed, tiny bound (e.g. a constant list of status labels)."""
    from pyspark.sql import Window

    w = Window.orderBy(*order)
    return df.select((F.row_number().over(w) + F.lit(start)).cast("long").alias(key), *df.columns)
