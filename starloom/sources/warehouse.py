"""Staging and the star warehouse as Parquet.

Dimensions are copy-on-write: each load writes them under a new version folder. The fact table
is append-only (facts are insert-once): one table bucketed on ``(order_id, order_item_seq)`` and
partitioned by ``load_version``; a load inserts only its new rows into its own partition. A commit
record written last makes a version visible; readers take the highest committed version and
ignore fact partitions above it, so a load that died half-way is invisible; a retry takes the next
free version number. Nothing is overwritten or deleted. One writer at a time is assumed (a second
commit of the same version fails).

The bucket count belongs to the table (recorded in each commit) and is chosen at the first publish;
:func:`rebucket_facts` moves the table to another one. The bucketing lets the next load's insert-once anti-join and the lookups read the existing fact
keys without shuffling them: only the incoming batch is shuffled to the table's buckets.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from starloom.frames import empty_frame, rows_frame
from starloom.schemas import STAR_SCHEMAS
from starloom.session import COMPACT

COMMITS = "_commits"
COMMIT_SCHEMA = "version long, table string, rows long, committed_at timestamp, buckets int, max_key long"
SURROGATES = {"dim_status": "status_key", "dim_customer": "customer_key", "dim_product": "product_key", "fact_orders": "fact_id"}
FACT = "fact_orders"
FACT_KEYS = ("order_id", "order_item_seq")
LOAD_VERSION = "load_version"


def write_staging(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path, compression=COMPACT)
    return path


def read_staging(spark: SparkSession, path: str) -> DataFrame | None:
    """A staged table, or ``None`` when it was never written."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return None
        raise


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    """A missing table reads as an empty frame of its fixed schema."""
    return empty_frame(spark, STAR_SCHEMAS[table])


def _commits(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(COMMIT_SCHEMA).parquet(f"{root}/{COMMITS}/v*")
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return None
        raise


def current_version(spark: SparkSession, root: str) -> int:
    """Highest committed version (0 when nothing was published)."""
    commits = _commits(spark, root)
    if commits is None:
        return 0
    row = commits.agg(F.max("version").alias("v")).first()
    return int(row["v"]) if row["v"] is not None else 0


def _commit_info(spark: SparkSession, root: str, version: int) -> dict[str, Row]:
    """``table -> (rows, buckets, max_key)`` of one commit (a handful of rows)."""
    commits = _commits(spark, root)
    if commits is None or version == 0:
        return {}
    rows = commits.where(F.col("version") == version).select("table", "rows", "buckets", "max_key").collect()
    return {r["table"]: r for r in rows}


def max_keys(spark: SparkSession, root: str) -> dict[str, int]:
    """Largest surrogate key of each table, from the latest commit record (no scan of the tables)."""
    info = _commit_info(spark, root, current_version(spark, root))
    return {t: int(info[t]["max_key"] or 0) if t in info else 0 for t in SURROGATES}


def current_rows(spark: SparkSession, root: str, table: str = FACT) -> int:
    """Rows of a table, from the latest commit record."""
    info = _commit_info(spark, root, current_version(spark, root))
    return int(info[table]["rows"]) if table in info else 0


def fact_buckets_of(spark: SparkSession, root: str) -> int | None:
    """Bucket count of the published fact table."""
    info = _commit_info(spark, root, current_version(spark, root))
    return int(info[FACT]["buckets"]) if FACT in info else None


def _fact_folder(root: str, buckets: int) -> str:
    return f"{root}/{FACT}-{buckets}"


def _fact_table_name(root: str, buckets: int) -> str:
    return "starloom_fact_" + hashlib.sha1(_fact_folder(root, buckets).encode("utf-8")).hexdigest()[:16]


def _register_facts(spark: SparkSession, root: str, buckets: int) -> str:
    """Register (idempotently) the bucketed, version-partitioned fact table over its folder."""
    name = _fact_table_name(root, buckets)
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in STAR_SCHEMAS[FACT].fields)
    keys = ", ".join(FACT_KEYS)
    location = _fact_folder(root, buckets).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({cols}, {LOAD_VERSION} INT) USING parquet "
        f"PARTITIONED BY ({LOAD_VERSION}) CLUSTERED BY ({keys}) INTO {buckets} BUCKETS "
        f"LOCATION '{location}'"
    )
    try:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    except Exception as exc:  # no fact rows were ever written: nothing to recover
        if "does not exist" not in str(exc):
            raise
    return name


def read_star(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """All star tables of a committed version (latest by default); empty tables when none exists."""
    v = current_version(spark, root) if version is None else version
    if v == 0:
        return {t: empty_table(spark, t) for t in STAR_SCHEMAS}
    info = _commit_info(spark, root, v)
    out = {
        t: spark.read.schema(STAR_SCHEMAS[t]).parquet(f"{root}/v{v:08d}/{t}") for t in STAR_SCHEMAS if t != FACT
    }
    name = _register_facts(spark, root, int(info[FACT]["buckets"]))
    # Only partitions with a commit record are visible (a crashed load's partition never is).
    facts = spark.table(name).where(F.col(LOAD_VERSION).isin(committed_versions(spark, root, v)))
    out[FACT] = facts.select(*[F.col(f.name) for f in STAR_SCHEMAS[FACT].fields])
    return out


def committed_versions(spark: SparkSession, root: str, up_to: int | None = None) -> list[int]:
    """The loads whose facts are visible in the latest (or the given) version."""
    commits = _commits(spark, root)
    if commits is None:
        return []
    if up_to is not None:
        commits = commits.where(F.col("version") <= up_to)
    return sorted(int(r["version"]) for r in commits.select("version").distinct().collect())


def read_load(spark: SparkSession, root: str, version: int) -> DataFrame:
    """The facts that one load added, from its own partition."""
    info = _commit_info(spark, root, version)
    if FACT not in info:
        raise ValueError(f"version {version} of {root} was never committed")
    facts = spark.table(_register_facts(spark, root, int(info[FACT]["buckets"]))).where(F.col(LOAD_VERSION) == version)
    return facts.select(*[F.col(f.name) for f in STAR_SCHEMAS[FACT].fields])


def publish_star(
    spark: SparkSession,
    root: str,
    tables: Mapping[str, DataFrame],
    run_ts: dt.datetime,
    new_facts: DataFrame | None = None,
    fact_buckets: int | None = None,
    rebucket: bool = False,
) -> tuple[int, dict[str, int]]:
    """Publish a load. Returns ``(version, rows per table)``.

    Dimensions are written whole under the new version folder. Facts: only ``new_facts`` (the
    rows the load inserted) are appended, in their own ``load_version`` partition. The first publish
    may leave ``new_facts`` out: the whole ``fact_orders`` frame is new then; on a warehouse that
    holds facts this would load them again and raises ``ValueError``. Row counts and largest keys come
    from ``Observation``s on the writes, not from a second pass.
    """
    committed = current_version(spark, root)
    previous = _commit_info(spark, root, committed)
    if new_facts is None and committed:
        raise ValueError(f"{root} holds facts already: pass new_facts, the rows this load inserted")
    known = None if rebucket or FACT not in previous else int(previous[FACT]["buckets"])
    buckets = known or fact_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = _register_facts(spark, root, buckets)
    # Skip version numbers a crashed, uncommitted attempt already used for fact rows.
    taken = {int(r[0].split("=", 1)[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    version = committed + 1
    while version in taken:
        version += 1
    counts: dict[str, int] = {}
    largest: dict[str, int] = {}

    def watched(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
        obs = Observation(f"rows_{name}_{version}")
        key = F.max(SURROGATES[name]) if name in SURROGATES else F.lit(None)
        return df.observe(obs, F.count(F.lit(1)).alias("rows"), key.cast("long").alias("max_key")), obs

    for name, df in tables.items():
        if name == FACT:
            continue
        df, obs = watched(df, name)
        # The version folder is invisible until committed, so replacing a stale one is safe.
        df.write.mode("overwrite").parquet(f"{root}/v{version:08d}/{name}")
        counts[name], largest[name] = int(obs.get["rows"]), int(obs.get["max_key"] or 0)
    facts = new_facts if new_facts is not None else tables[FACT]
    # One task per bucket, each writes a single file; rows that were hash-partitioned by the keys into
    # as many partitions (``append_once``) do not move again.
    placed = facts.select(*[F.col(f.name) for f in STAR_SCHEMAS[FACT].fields]).repartition(buckets, *FACT_KEYS)
    appended, obs = watched(placed.withColumn(LOAD_VERSION, F.lit(version)), FACT)
    appended.write.insertInto(table, overwrite=False)
    before = previous[FACT] if FACT in previous and not rebucket else None
    counts[FACT] = (int(before["rows"]) if before else 0) + int(obs.get["rows"])
    largest[FACT] = max(int(before["max_key"] or 0) if before else 0, int(obs.get["max_key"] or 0))
    commit = rows_frame(
        spark,
        [(version, name, rows, run_ts, buckets if name == FACT else 0, largest[name]) for name, rows in counts.items()],
        COMMIT_SCHEMA,
    )
    commit.coalesce(1).write.mode("errorifexists").parquet(f"{root}/{COMMITS}/v{version:08d}")
    return version, counts


def rebucket_facts(spark: SparkSession, root: str, buckets: int, run_ts: dt.datetime) -> int:
    """Publish the current star again with the facts in ``buckets`` buckets; returns the version.

    Earlier versions stay readable in their own bucketing.
    """
    star = read_star(spark, root)
    return publish_star(spark, root, star, run_ts, new_facts=star[FACT], fact_buckets=buckets, rebucket=True)[0]
