"""End-to-end run with step selection: extract -> transform -> load -> quality.

Every step reads its inputs from storage written by the previous step (raw zone, staging zone,
versioned warehouse), so steps can run separately, as in a scheduled daily run, and a re-run
is idempotent: dimensions are upserted, facts are insert-once, and each load publishes a new
warehouse version.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.counters import Counters
from starloom.operators.gate import incremental_quality_checks, load_measures
from starloom.operators.quality import run_quality_gate
from starloom.params import Params
from starloom.plans.star import RawSources, Staged, load_star, stage, transform
from starloom.sources.csv import land_raw, normalize_na, read_csv
from starloom.sources.jdbc import extract_order_events
from starloom.sources.json_records import read_json_array, read_json_lines
from starloom.session import scratch
from starloom.sources.warehouse import (
    committed_versions,
    current_rows,
    current_version,
    fact_buckets_of,
    max_keys,
    publish_star,
    read_load,
    read_staging,
    read_star,
)

STEPS = ("extract", "transform", "load", "quality")
CSV_SOURCES = ("customers", "orders", "order_items", "products")


@dataclass
class PipelineConfig:
    """Where data lives. Source paths may be files, folders or globs."""

    sources: dict[str, str]  # customers, orders, order_items, products -> CSV path
    raw_root: str
    staging_root: str
    warehouse_root: str
    report_root: str | None = None
    api_products: str | None = None  # JSON array document(s) of catalog records
    api_format: str = "array"  # "array" (one document per file) or "lines" (JSON Lines)
    order_events: str | None = None  # landed CSV extract of the operational database
    jdbc_url: str | None = None  # or read the operational database directly
    jdbc_properties: dict[str, str] = field(default_factory=dict)
    jdbc_partitions: int = 8  # parallel range reads of each database table
    # Buckets of the fact table, set at its first publish (by default the session's shuffle partitions);
    # size them for about 1 GB a bucket. `rebucket_facts` changes them later.
    fact_buckets: int | None = None
    # Lines that do not load, with their reason, one folder a load (`load_version=n`).
    reject_root: str | None = None
    # Measures of each load, for a gate that reads the facts of new loads only.
    gate_root: str | None = None


@dataclass
class PipelineResult:
    steps: list[str] = field(default_factory=list)
    raw_paths: dict[str, str] = field(default_factory=dict)
    version: int | None = None
    raw_rows: dict[str, int] = field(default_factory=dict)  # rows landed per source
    staged_rows: dict[str, int] = field(default_factory=dict)  # rows per staged table
    rows: dict[str, int] = field(default_factory=dict)  # table totals after the load
    # Rows read, dropped, rejected and enriched by the transform; facts inserted and skipped by the load.
    counters: dict[str, int] = field(default_factory=dict)
    quality: dict | None = None


def extract(spark: SparkSession, cfg: PipelineConfig, counts: dict[str, int] | None = None) -> dict[str, str]:
    """Read every source and land it in the raw zone (Parquet, input ordinal included)."""
    frames: dict[str, DataFrame] = {name: read_csv(spark, cfg.sources[name], name=name) for name in CSV_SOURCES}
    if cfg.api_products:
        reader = read_json_array if cfg.api_format == "array" else read_json_lines
        frames["api_records"] = reader(spark, cfg.api_products)
    if cfg.jdbc_url:
        events = extract_order_events(spark, cfg.jdbc_url, cfg.jdbc_properties, cfg.jdbc_partitions)
        frames["order_events"] = events
    elif cfg.order_events:
        frames["order_events"] = read_csv(
            spark, cfg.order_events, name="order_events", required=("order_id", "status", "event_timestamp")
        )
    # The database extract is landed in its own order, so later reads of an order touch few files.
    clustered = {"order_events": ("order_id", "event_timestamp", "event_id")} if cfg.jdbc_url else None
    return land_raw(frames, cfg.raw_root, counts, clustered)


def load_raw(spark: SparkSession, cfg: PipelineConfig) -> RawSources:
    def get(name: str) -> DataFrame | None:
        return read_staging(spark, f"{cfg.raw_root}/{name}")

    missing = [n for n in CSV_SOURCES if get(n) is None]
    if missing:
        raise FileNotFoundError(f"Raw extracts missing for {missing} under {cfg.raw_root}: run the extract step")
    events = get("order_events")
    if events is not None:
        events = normalize_na(events)
    return RawSources(
        customers=get("customers"),
        orders=get("orders"),
        order_items=get("order_items"),
        products=get("products"),
        api_records=get("api_records"),
        order_events=events,
    )


def read_staged(spark: SparkSession, cfg: PipelineConfig) -> Staged:
    parts = {n: read_staging(spark, f"{cfg.staging_root}/{n}") for n in ("customers_clean", "products_clean", "orders_clean", "dim_date")}
    missing = [n for n, df in parts.items() if df is None]
    if missing:
        raise FileNotFoundError(f"Staged tables missing: {missing}; run the transform step")
    return Staged(parts["customers_clean"], parts["products_clean"], parts["orders_clean"], parts["dim_date"])


def load(spark: SparkSession, cfg: PipelineConfig, params: Params, run_ts: dt.datetime, result: PipelineResult) -> None:
    """Load the staged tables into the warehouse and publish the next version."""
    counters = Counters()
    staged = read_staged(spark, cfg)
    staged = staged._replace(lines=counters(staged.lines, "staged", lines=F.count(F.lit(1))))
    root = cfg.warehouse_root
    buckets = fact_buckets_of(spark, root) or cfg.fact_buckets
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    current = read_star(spark, root)
    before = current_rows(spark, root)
    reasons = Counters()
    star, report = load_star(
        current, staged, params, run_ts, buckets, max_keys(spark, root), keep_rejects=cfg.reject_root is not None, counters=reasons
    )
    result.version, result.rows = publish_star(
        spark, root, star, run_ts, new_facts=report.inserted["fact_orders"], fact_buckets=buckets
    )
    inserted = result.rows["fact_orders"] - before
    result.counters["facts_inserted"] = inserted
    result.counters["facts_skipped"] = counters.values()["staged_lines"] - inserted
    if report.rejects is not None:
        result.counters |= reasons.values()
        report.rejects.write.mode("overwrite").parquet(f"{cfg.reject_root}/load_version={result.version}")
    if cfg.gate_root is not None:
        added = load_measures(read_load(spark, root, result.version))
        added.write.mode("overwrite").parquet(f"{cfg.gate_root}/load_version={result.version}")


def gate_checks(spark: SparkSession, cfg: PipelineConfig, star: dict[str, DataFrame], lines: DataFrame | None, params: Params) -> DataFrame:
    """The gate from the measures of the committed loads; a load without any is measured now."""
    committed = committed_versions(spark, cfg.warehouse_root)
    known = read_staging(spark, cfg.gate_root)
    have = set() if known is None else {r[0] for r in known.select("load_version").distinct().collect()}
    parts = [] if known is None else [known.where(F.col("load_version").isin(committed)).select("metric", "column", "key", "n")]
    parts += [load_measures(read_load(spark, cfg.warehouse_root, v)) for v in committed if v not in have]
    measures = parts[0]
    for p in parts[1:]:
        measures = measures.unionByName(p)
    return incremental_quality_checks(measures, star, lines, params)


def run_pipeline(
    spark: SparkSession,
    cfg: PipelineConfig,
    params: Params = Params(),
    run_ts: dt.datetime | None = None,
    steps: Sequence[str] = STEPS,
) -> PipelineResult:
    """Run the selected steps in order; the quality gate raises when a check fails."""
    unknown = set(steps) - set(STEPS)
    if unknown:
        raise ValueError(f"unknown steps {sorted(unknown)}; choose from {STEPS}")
    run_ts = run_ts or dt.datetime.now().replace(microsecond=0)
    result = PipelineResult()
    if "extract" in steps:
        result.raw_paths = extract(spark, cfg, result.raw_rows)
        result.steps.append("extract")
    if "transform" in steps:
        counters = Counters()
        stage(transform(load_raw(spark, cfg), params, counters), cfg.staging_root, result.staged_rows)
        result.counters |= counters.values()
        result.steps.append("transform")
    if "load" in steps:
        # The copies of new dimensions and keys are needed until the publish only.
        with scratch(spark):
            load(spark, cfg, params, run_ts, result)
        result.steps.append("load")
    if "quality" in steps:
        star = read_star(spark, cfg.warehouse_root)
        lines = read_staging(spark, f"{cfg.staging_root}/orders_clean")
        checks = gate_checks(spark, cfg, star, lines, params) if cfg.gate_root and current_version(spark, cfg.warehouse_root) else None
        result.quality = run_quality_gate(star, lines, params, cfg.report_root, run_ts, checks)
        result.steps.append("quality")
    return result
