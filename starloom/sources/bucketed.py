"""Append-only bucketed Parquet tables: one partition a load, each hashed into the same buckets.

Spark's own bucketing: a read is already partitioned by the keys, so aggregates and joins by them move
nothing of the table, and an append moves only the new rows. A load's partition is visible once its
version is among those the reader asks for (committed loads); nothing is overwritten.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.frames import empty_frame

LOAD_VERSION = "load_version"


@dataclass(frozen=True)
class BucketedTable:
    folder: str
    schema: T.StructType
    keys: tuple[str, ...]
    buckets: int
    compression: str | None = None

    @property
    def name(self) -> str:
        own = f"{self.folder}|{self.buckets}"
        return "starloom_" + hashlib.sha1(own.encode("utf-8")).hexdigest()[:20]

    def register(self, spark: SparkSession) -> str:
        """Name the table in the session's catalog (idempotent) and find its partitions."""
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        location = self.folder.replace("\\", "\\\\").replace("'", "\\'")
        keys = ", ".join(f"`{k}`" for k in self.keys)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({cols}, {LOAD_VERSION} INT) USING parquet "
            f"PARTITIONED BY ({LOAD_VERSION}) CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS "
            f"LOCATION '{location}'" + (f" OPTIONS (compression '{self.compression}')" if self.compression else "")
        )
        try:
            spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")
        except Exception as exc:  # the folder is made by the first write
            if "does not exist" not in str(exc):
                raise
        return self.name

    def versions(self, spark: SparkSession) -> list[int]:
        """Loads that have a partition, committed or not."""
        name = self.register(spark)
        return sorted(int(r[0].split("=", 1)[1]) for r in spark.sql(f"SHOW PARTITIONS {name}").collect())

    def append(self, df: DataFrame, version: int) -> None:
        """Write the rows of one load: one shuffle (none if they lie in the buckets already), one file a
        bucket. A version that has a partition is refused; a retry takes the next number."""
        spark = df.sparkSession
        if version in self.versions(spark):
            raise ValueError(f"load {version} of {self.folder} was written already")
        placed = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]).repartition(self.buckets, *self.keys)
        placed.sortWithinPartitions(*self.keys).withColumn(LOAD_VERSION, F.lit(version)).write.insertInto(self.name, overwrite=False)

    def read(self, spark: SparkSession, versions: Iterable[int] | None = None) -> DataFrame:
        """All rows of the given loads (default: every load), with ``load_version``."""
        have = self.versions(spark)
        wanted = have if versions is None else [v for v in have if v in set(versions)]
        if not wanted:
            return empty_frame(spark, self.schema).withColumn(LOAD_VERSION, F.lit(None).cast("int"))
        df = spark.table(self.name)
        return df if wanted == have else df.where(F.col(LOAD_VERSION).isin(wanted))


def bucketed_table(
    folder: str, schema: T.StructType | str, keys: Sequence[str], buckets: int, compression: str | None = None
) -> BucketedTable:
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    return BucketedTable(folder, schema, tuple(keys), buckets, compression)
