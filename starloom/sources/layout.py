"""Landing in sorted order: files of disjoint ranges, each sorted, so that a filter on the sort columns
reads few of them (Parquet's own minima and maxima) and a later merge or range join need not sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], partitions: int | None = None) -> str:
    """Write ``df`` range-partitioned and sorted by ``columns`` (nulls first).

    A sample gives the ranges, one shuffle deals them, each task sorts its own. Equal values of all
    columns stay in one file; add a column that tells rows apart where one value may hold many rows.
    """
    by = [F.col(c).asc_nulls_first() for c in columns]
    placed = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    placed.sortWithinPartitions(*by).write.mode("overwrite").parquet(path)
    return path


def _rank(columns: Sequence[str]) -> Column:
    """The sort columns as one comparable value, nulls first as in the sort."""
    return F.struct(*[F.struct(F.col(c).isNotNull().alias("known"), F.col(c).alias("value")).alias(c) for c in columns])


def layout_report(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """``(files, rows, unsorted_rows, overlapping_files)`` of a folder of Parquet files.

    ``unsorted_rows``: rows less than the row before them in their file (a window a file, so a task holds
    one file's rows at most); ``overlapping_files``: files whose least value is not above the greatest of
    the files before them. The order of files is that of their least values (one row a file).
    """
    rows = spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), _rank(columns).alias("at")
    )
    before = F.lag("at").over(Window.partitionBy("file").orderBy("row"))
    per_file = (
        rows.withColumn("unsorted", F.coalesce(F.col("at") < before, F.lit(False)).cast("long"))
        .groupBy("file")
        .agg(F.count("*").alias("rows"), F.sum("unsorted").alias("unsorted"), F.min("at").alias("lo"), F.max("at").alias("hi"))
    )
    earlier = F.max("hi").over(Window.orderBy("lo", "hi", "file").rowsBetween(Window.unboundedPreceding, -1))
    return per_file.withColumn("overlaps", F.coalesce(F.col("lo") <= earlier, F.lit(False)).cast("long")).agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("unsorted"), F.lit(0)).alias("unsorted_rows"),
        F.coalesce(F.sum("overlaps"), F.lit(0)).alias("overlapping_files"),
    )
