"""Session helpers for tests, the bench and the command line.

Library functions never create sessions; they take the caller's ``SparkSession``.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings the pipeline relies on. They are applied only when the caller has not set them.
RECOMMENDED_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "starloom") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("STARLOOM_DRIVER_MEMORY", "8g"))
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, allow_local_fallback=True)
    return spark


def _one_machine(master: str) -> bool:
    """``local`` and ``local[...]``; a ``local-cluster[...]`` has executors of its own."""
    return re.fullmatch(r"local(\[.*\])?", master) is not None


def ensure_checkpoint_dir(spark: SparkSession, allow_local_fallback: bool = False) -> str:
    """Return the session's reliable checkpoint directory.

    The cluster names a shared folder in ``spark.checkpoint.dir``; it is used as is. Only a
    local test session (``allow_local_fallback``) may fall back to a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not allow_local_fallback or not _one_machine(sc.master):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: configure a shared folder for reliable checkpoints"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="starloom-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


_SCRATCH: ContextVar[str | None] = ContextVar("starloom_scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables that :func:`cut_lineage` writes inside the block are deleted at its end.

    Frames built in the block must be written where they are wanted before it ends.
    """
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/starloom-run-{uuid.uuid4().hex}"
    token = _SCRATCH.set(path)
    try:
        yield path
    finally:
        _SCRATCH.reset(token)
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name (not yet made) below the checkpoint folder, or below that of :func:`scratch`."""
    root = _SCRATCH.get() or ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/starloom-{label}-{uuid.uuid4().hex}"


# What holds a row a fact line is written so: smaller than with Parquet's default.
COMPACT = "zstd"


def cut_lineage(df: DataFrame, label: str = "table", compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the reliable checkpoint folder and read it back.

    One computation of the plan (``DataFrame.checkpoint`` computes it twice: once for the
    action, once more to write the files). Inside :func:`scratch` the copy is deleted at its end;
    otherwise it stays until the checkpoint folder is cleaned.
    """
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.parquet(path, compression=compression)
    # An empty result writes no data files: read back with the known schema.
    return spark.read.schema(df.schema).parquet(path)


def sort_bounded(df: DataFrame, *cols: str) -> DataFrame:
    """Total order for a frame with a known small bound (a dimension of calendar days, a report).

    One partition sorted in place: no range-sampling pass over the input. Never use it for
    data that grows with the fact volume.
    """
    return df.repartition(1).sortWithinPartitions(*cols)
