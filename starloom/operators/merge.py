"""Idempotent table updates without a transactional table format.

Built-in Parquet tables have no ``MERGE INTO``, so each update is a pure function
``(current table, batch) -> new table``; publishing writes the result to a new version
(:mod:`starloom.sources.warehouse`), never over the files being read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.dedup import keep_first, keep_last
from starloom.operators.keys import assign_strided_keys, assign_surrogate_keys, max_key, partition_position
from starloom.session import cut_lineage


def _not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def insert_new(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Insert-if-absent: rows whose key is not in ``target`` are appended; existing rows never change.

    Within the batch the first row per key wins (by ``order``, else by all columns, so a rerun picks
    the same row). Rows with a null key are ignored. Returns ``(new table, inserted rows)``.
    """
    src = source.where(_not_null(keys))
    src = keep_first(src, keys, order or [F.struct(*src.columns)])
    new = src.join(target.select(*keys), list(keys), "left_anti").select(*target.columns)
    return target.unionByName(new), new


def scd1_merge(
    target: DataFrame,
    source: DataFrame,
    key: str,
    attrs: Sequence[str],
    surrogate: str,
    run_ts: dt.datetime,
    order: Sequence[str | Column],
    updated_col: str = "updated_at",
    start: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Overwrite-in-place (SCD type 1) upsert on a natural key.

    * matched rows take the batch's attribute values (also nulls) and ``updated_at = run_ts``;
      their surrogate key is kept;
    * new keys are inserted with keys above the current maximum (``start``, else looked up), in
      natural-key order;
    * target rows absent from the batch are unchanged;
    * a key repeated in the batch: its last row (by ``order``) wins, as with sequential upserts.
    One full outer join, written once, gives both the updated and the new rows; flags decide, not
    ``source.col IS NULL``. Returns ``(new table, inserted rows)``.
    """
    ts = F.lit(run_ts).cast("timestamp")
    src = keep_last(source.where(F.col(key).isNotNull()), [key], order).select(key, *attrs)
    s = src.select(F.col(key), *[F.col(a).alias(f"_src_{a}") for a in attrs], F.lit(True).alias("_matched"))
    joined = target.withColumn("_old", F.lit(True)).join(s, key, "full")
    merged = cut_lineage(
        joined.select(
            *[
                F.when(F.col("_matched"), F.col(f"_src_{c}")).otherwise(F.col(c)).alias(c)
                if c in attrs
                else F.when(F.col("_matched"), ts).otherwise(F.col(c)).alias(c)
                if c == updated_col
                else F.col(c)
                for c in target.columns
            ],
            F.coalesce("_old", F.lit(False)).alias("_old"),
        ),
        f"merged-{surrogate}",
    )
    fresh = merged.where(~F.col("_old")).drop("_old", surrogate)
    first = max_key(target, surrogate) if start is None else start
    inserted = assign_surrogate_keys(fresh, surrogate, [key], start=first, stored=True).select(*target.columns)
    return merged.where("_old").drop("_old").unionByName(inserted), inserted


def append_once(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    surrogate: str,
    run_ts: dt.datetime | None = None,
    loaded_col: str | None = "loaded_at",
    partitions: int | None = None,
    start: int | None = None,
    placed_by: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Insert-once rows on a unique key: first batch row wins, rows already loaded never change.

    The batch is hash-partitioned by ``keys`` once, into ``partitions`` (the table's buckets, where
    it has them): removing duplicates, the anti join, the new rows' surrogate keys (above ``start``,
    else above the current maximum; no order) and a bucketed write all use that partitioning.
    ``placed_by``: the batch lies hashed by these of the keys already; it is not moved where the table is empty.
    Returns ``(new table, inserted rows)``.
    """
    n = partitions or int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = batch.where(_not_null(keys)).repartition(n, *(placed_by or keys))
    new = keep_first(placed, keys, order).join(target.select(*keys), list(keys), "left_anti")
    if loaded_col is not None:
        new = new.withColumn(loaded_col, F.lit(run_ts).cast("timestamp"))
    first = max_key(target, surrogate) if start is None else start
    inserted = assign_strided_keys(new, surrogate, list(keys), n, start=first, placed_by=placed_by).select(*target.columns)
    return target.unionByName(inserted), inserted


def latest_rows(log: DataFrame, key: str, version: str = "load_version") -> DataFrame:
    """The current dimension: of each key the row of its latest load. Over a table bucketed by ``key``
    this is one aggregate without a shuffle."""
    others = [c for c in log.columns if c not in (key, version)]
    latest = log.groupBy(key).agg(F.max_by(F.struct(*others), version).alias("_row"))
    return latest.select(*[F.col(key) if c == key else F.col("_row")[c].alias(c) for c in log.columns if c != version])


def scd1_delta(
    log: DataFrame,
    batch: DataFrame,
    key: str,
    attrs: Sequence[str],
    surrogate: str,
    run_ts: dt.datetime,
    order: Sequence[str | Column],
    buckets: int,
    start: int,
    updated_col: str = "updated_at",
) -> DataFrame:
    """The rows one load adds to a dimension kept as a log of loads, bucketed by ``key``.

    As :func:`scd1_merge`: a matched key keeps its surrogate and takes the batch's attributes (also
    nulls) and ``run_ts``; a new key gets a surrogate above ``start``, unique but in no order; of a key
    repeated in the batch the last row counts. Rows that the batch does not name are neither moved nor
    written again: the batch is shuffled to the buckets, the log is read where it lies.
    """
    src = batch.where(F.col(key).isNotNull()).repartition(buckets, key)
    src = keep_last(src, [key], order).select(key, *attrs)
    known = latest_rows(log, key).select(F.col(key).alias("_key"), F.col(surrogate).alias("_old"))
    found = src.join(known, F.col(key) == F.col("_key"), "left").drop("_key")
    # New keys by their place in the bucket: the partitioning is that of the batch, so nothing moves.
    placed = found.sortWithinPartitions(F.col("_old").isNotNull(), key)
    fresh = (F.lit(start + 1) + F.spark_partition_id() + partition_position() * F.lit(buckets)).cast("long")
    return placed.select(
        F.coalesce("_old", fresh).alias(surrogate), F.col(key), *[F.col(a) for a in attrs], F.lit(run_ts).cast("timestamp").alias(updated_col)
    )
