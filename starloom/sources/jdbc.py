"""Operational database extract: order events joined to their order headers.

Both tables are read with partitioned JDBC scans (events by their numeric id, headers by their
creation time) and the join runs in Spark, so the database only serves parallel range reads.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_COLUMNS = ("event_id", "order_id", "status", "event_timestamp", "seller_id", "notes")


def jdbc_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options for ``spark.read.format('jdbc')``; range-partitioned when a column and bounds are given."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **dict(properties or {})}
    if partition_column is not None and bounds is not None:
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(num_partitions or 1),
        )
    return opts


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def column_bounds(spark: SparkSession, url: str, table: str, column: str, properties=None) -> tuple[object, object] | None:
    """``(min, max)`` of a numeric, date or time column, pushed to the database as one tiny query."""
    q = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) b"
    row = read_jdbc(spark, url=url, table=q, properties=properties).first()
    if row is None or row["lo"] is None:
        return None
    return row["lo"], row["hi"]


def events_with_headers(events: DataFrame, headers: DataFrame, sort: bool = True) -> DataFrame:
    """Events left-joined to order headers (events without a header keep null header fields).

    Output columns: ``event_id, order_id, status, event_timestamp, seller_id, notes, customer_id,
    order_created_at, expected_delivery, channel``; optionally ordered by ``(order_id, event_timestamp)``.
    """
    h = headers.select(
        "order_id",
        "customer_id",
        F.col("created_at").alias("order_created_at"),
        "expected_delivery",
        "channel",
    )
    out = events.select(*EVENT_COLUMNS).join(h, "order_id", "left").select(
        *EVENT_COLUMNS, "customer_id", "order_created_at", "expected_delivery", "channel"
    )
    return out.orderBy("order_id", "event_timestamp") if sort else out


def read_partitioned(spark: SparkSession, url: str, table: str, column: str, num_partitions: int, properties=None) -> DataFrame:
    """A table in ``num_partitions`` ranges of ``column`` (rows where it is null go with the first)."""
    bounds = column_bounds(spark, url, table, column, properties)
    return read_jdbc(
        spark,
        url=url,
        table=table,
        properties=properties,
        partition_column=column if bounds else None,
        bounds=bounds,
        num_partitions=num_partitions,
    )


def extract_order_events(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str] | None = None,
    num_partitions: int = 8,
    events_table: str = "order_events",
    headers_table: str = "raw_orders",
    headers_column: str = "created_at",
    sort: bool = False,
) -> DataFrame:
    """Partitioned reads of both tables and the join in Spark; ordered only on request."""
    events = read_partitioned(spark, url, events_table, "event_id", num_partitions, properties)
    headers = read_partitioned(spark, url, headers_table, headers_column, num_partitions, properties)
    return events_with_headers(events, headers, sort=sort)
