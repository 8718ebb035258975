"""Transform raw sources into staged tables and load them into the star schema.

``transform`` and ``load_star`` are pure functions of DataFrames; ``run_pipeline`` adds the
reads and the versioned publish.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.frames import rows_frame
from starloom.operators.counters import Counters
from starloom.operators.clean import clean_customers, clean_orders, clean_products, customer_aliases, resolve_aliases
from starloom.operators.enrich import api_enrichment
from starloom.operators.facts import PLACED_BY, reason_counts, resolve_fact_keys, route_fact_lines, tag_fact_lines
from starloom.operators.keys import assign_small_keys, max_key
from starloom.operators.merge import append_once, insert_new, scd1_merge
from starloom.params import Params
from starloom.schemas import STAR_SCHEMAS
from starloom.session import COMPACT, cut_lineage, shared_folder
from starloom.sources.bucketed import bucketed_table
from starloom.sources.json_records import flatten_api_products, has_keys, validate_records
from starloom.sources.warehouse import empty_table

ORD = "_ord"


@dataclass
class RawSources:
    """Raw inputs: string columns, missing markers already null, optional ``_ord`` ordinal."""

    customers: DataFrame
    orders: DataFrame
    order_items: DataFrame
    products: DataFrame
    api_records: DataFrame | None = None  # raw JSON records ``(doc, pos, record)``
    order_events: DataFrame | None = None  # event_id, order_id, status, event_timestamp (strings)


class Staged(NamedTuple):
    customers: DataFrame
    products: DataFrame
    lines: DataFrame
    dim_date: DataFrame
    buckets: int | None = None  # the lines lie in so many buckets by order id


@dataclass
class LoadReport:
    inserted: dict[str, DataFrame] = field(default_factory=dict)
    rejects: DataFrame | None = None  # lines not loaded, with their reason, if they were asked for


def transform(raw: RawSources, params: Params = Params(), counters: Counters | None = None) -> Staged:
    """The three cleaning transforms (customers, orders + dates, products)."""
    watch = counters or (lambda df, name, **_: df)
    rows = F.count(F.lit(1))
    keyless = F.col("customer_id").isNull() | F.col("customer_unique_id").isNull()
    customers = clean_customers(watch(raw.customers, "customers", raw=rows, dropped=F.count_if(keyless)))
    orders = clean_orders(raw.orders, raw.order_items, raw.order_events, params, counters)
    lines = orders.lines
    if params.resolve_aliases:
        lines = resolve_aliases(lines, customer_aliases(raw.customers))
    enrichment = None
    if raw.api_records is not None:
        records = watch(raw.api_records, "catalog", raw=rows, dropped=F.count_if(~has_keys(F.col("record"))))
        enrichment = api_enrichment(flatten_api_products(validate_records(records)))
    raw_products = watch(raw.products, "products", raw=rows, dropped=F.count_if(F.col("product_id").isNull()))
    return Staged(customers, clean_products(raw_products, enrichment), lines, orders.dim_date)


def stage(
    staged: Staged, staging_root: str | None = None, counts: dict[str, int] | None = None, buckets: int | None = None
) -> Staged:
    """Write the staged tables once and continue from the written copies.

    Lines feed both the fact load and the date dimension; reading them back means the cleaning
    and joins run once. With ``staging_root`` the tables land in the staging zone (Parquet, one
    folder per table); otherwise in the reliable checkpoint folder, where the lines can be kept in
    ``buckets`` by order id: joining orders and items has hashed them so, and the load need not move them.
    """
    from starloom.operators.clean import dim_date_from_lines
    from starloom.operators.counters import observed
    from starloom.sources.warehouse import write_staging

    def put(df: DataFrame, name: str) -> DataFrame:
        schema = df.schema
        df, obs = observed(df, f"staged_{name}")
        if name == "orders_clean" and buckets is not None and staging_root is None:
            table = bucketed_table(shared_folder(df.sparkSession, f"staged-{name}"), schema, [PLACED_BY], buckets, COMPACT)
            table.append(df, 1)
            out = table.read(df.sparkSession).select(*schema.names)
        elif staging_root is None:
            out = cut_lineage(df, f"staged-{name}", COMPACT)
        else:
            out = df.sparkSession.read.schema(schema).parquet(write_staging(df, f"{staging_root}/{name}"))
        if counts is not None:
            counts[name] = int(obs.get["rows"])
        return out

    lines = put(staged.lines, "orders_clean")
    return Staged(
        customers=put(staged.customers, "customers_clean"),
        products=put(staged.products, "products_clean"),
        lines=lines,
        dim_date=put(dim_date_from_lines(lines), "dim_date"),
        buckets=buckets if staging_root is None else None,
    )


def empty_star(spark: SparkSession) -> dict[str, DataFrame]:
    return {t: empty_table(spark, t) for t in STAR_SCHEMAS}


def load_dim_status(target: DataFrame, statuses: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Insert missing labels of the configured list; new keys follow list order."""
    spark = target.sparkSession
    src = rows_frame(spark, [(s, i) for i, s in enumerate(statuses)], "status_label string, pos int")
    new = src.join(target.select("status_label"), "status_label", "left_anti")
    # The list is a configuration constant (a handful of rows): a plain window is fine here.
    keyed = assign_small_keys(new, "status_key", ["pos"], start=max_key(target, "status_key"))
    inserted = keyed.select("status_key", "status_label")
    return target.unionByName(inserted), inserted


def _with_order(df: DataFrame) -> DataFrame:
    """Without an ingest ordinal all columns decide which row is first, so reruns agree."""
    return df if ORD in df.columns else df.withColumn(ORD, F.struct(*df.columns))


def load_star(
    star: dict[str, DataFrame] | None,
    staged: Staged,
    params: Params = Params(),
    run_ts: dt.datetime | None = None,
    fact_partitions: int | None = None,
    max_keys: Mapping[str, int] | None = None,
    keep_rejects: bool = False,
    counters: Counters | None = None,
) -> tuple[dict[str, DataFrame], LoadReport]:
    """Dimensions first (date, status, customer, product), then facts.

    Dimensions are overwrite-in-place upserts with stable surrogate keys; facts are insert-once
    on ``(order_id, order_item_seq)``. Reloading the same staged data changes nothing but
    ``updated_at``. Each new dimension is written once (to the reliable checkpoint folder); the fact
    lookup and the publish both read that copy. ``fact_partitions``: the fact table's bucket count;
    ``max_keys``: the largest surrogate keys so far, from the commit record, instead of a scan.
    ``keep_rejects`` writes all lines with their keys once and gives those that do not load as
    ``report.rejects``; ``counters`` then takes their number by reason.
    """
    run_ts = run_ts or dt.datetime.now().replace(microsecond=0)
    spark = staged.lines.sparkSession
    first_load = star is None
    star = empty_star(spark) if star is None else dict(star)
    report = LoadReport()
    start = dict(max_keys) if max_keys is not None else {}

    dim_date, report.inserted["dim_date"] = insert_new(star["dim_date"], staged.dim_date, ["date_key"])

    dim_status, report.inserted["dim_status"] = load_dim_status(star["dim_status"], params.valid_statuses)

    customers = _with_order(staged.customers).select(
        "customer_id",
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("city", "state", "zip_code")],
        ORD,
    )
    dim_customer, report.inserted["dim_customer"] = scd1_merge(
        star["dim_customer"],
        customers,
        "customer_id",
        ["city", "state", "zip_code"],
        "customer_key",
        run_ts,
        [ORD],
        start=start.get("dim_customer"),
    )

    products = _with_order(staged.products).select(
        "product_id",
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("category", "name")],
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ("api_price", "api_rating")],
        ORD,
    )
    dim_product, report.inserted["dim_product"] = scd1_merge(
        star["dim_product"],
        products,
        "product_id",
        ["category", "name", "api_price", "api_rating"],
        "product_key",
        run_ts,
        [ORD],
        start=start.get("dim_product"),
    )
    dims = {
        "dim_date": dim_date,
        "dim_status": dim_status,
        "dim_customer": dim_customer,
        "dim_product": dim_product,
    }
    dims = {name: cut_lineage(df, name) for name, df in dims.items()}

    # A table that holds facts or has buckets wants the lines by its own key; else they stay where they were staged.
    placed = staged.buckets if first_load and fact_partitions is None and not keep_rejects else None
    lookups = [dims[d] for d in ("dim_customer", "dim_product", "dim_date", "dim_status")]
    if keep_rejects:
        tagged = tag_fact_lines(_with_order(staged.lines), *lookups)
        if counters is not None:
            tagged = counters(tagged, "facts", **reason_counts())
        rows, report.rejects = route_fact_lines(cut_lineage(tagged, "tagged-lines", COMPACT))
    else:
        rows = resolve_fact_keys(_with_order(staged.lines), *lookups, buckets=placed)
    fact_orders, report.inserted["fact_orders"] = append_once(
        star["fact_orders"],
        rows,
        ["order_id", "order_item_seq"],
        [ORD],
        "fact_id",
        run_ts,
        partitions=placed or fact_partitions,
        start=start.get("fact_orders"),
        placed_by=[PLACED_BY] if placed is not None else None,
    )
    return {**dims, "fact_orders": fact_orders}, report


def materialize(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Write each table once to the reliable checkpoint folder and read it back.

    Later readers (quality checks, reports) then scan the loaded rows instead of re-running the
    load, and a lost executor cannot force a recomputation of the whole pipeline.
    """
    return {name: cut_lineage(df, name, COMPACT) for name, df in star.items()}
