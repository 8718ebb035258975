"""Cleaning transforms for customers, order lines (+ date dimension) and products.

Inputs are raw frames of string columns whose missing-value markers are already null
(:func:`starloom.sources.csv.normalize_na`). ``order`` names the column(s) that carry input
order (the ingest ordinal); "first" and "last" are defined by it.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import (
    date_key,
    dim_date_columns,
    infer_time_shapes,
    lenient_double,
    lenient_int,
    lenient_timestamp,
    shape_timestamp,
    strip_ws,
    title_case,
    zfill,
)
from starloom.operators.counters import Counters
from starloom.operators.dedup import aliases, keep_first
from starloom.operators.enrich import join_enrichment, map_category
from starloom.operators.latest import apply_latest_status, latest_status
from starloom.params import Params
from starloom.schemas import ORDER_TIME_COLUMNS

ORD = "_ord"


def _order(df: DataFrame, order: Sequence[str | Column] | None, fallback: Sequence[str]) -> list:
    if order:
        return list(order)
    if ORD in df.columns:
        return [ORD]
    return list(fallback)


# ----------------------------------------------------------------------------- customers


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dropna(subset=keys)``."""
    return df.dropna(subset=list(keys))


def clean_customers(raw: DataFrame, order: Sequence[str | Column] | None = None) -> DataFrame:
    """Drop null ids, keep the first row per ``customer_unique_id``, standardise text.

    Output: ``customer_id, customer_unique_id, city, state, zip_code`` (+ ``_ord`` if present).
    Dedup is on ``customer_unique_id`` while orders join on ``customer_id``: orders placed under a
    dropped alias are later skipped at load, as in the reference behaviour.
    """
    df = drop_null_keys(raw, ["customer_id", "customer_unique_id"])
    df = keep_first(df, ["customer_unique_id"], _order(df, order, ["customer_id"]))
    extra = [ORD] if ORD in df.columns else []
    return df.select(
        "customer_id",
        "customer_unique_id",
        F.coalesce(title_case(strip_ws("customer_city")), F.lit("Unknown")).alias("city"),
        F.coalesce(F.upper(strip_ws("customer_state")), F.lit("XX")).alias("state"),
        F.coalesce(zfill(strip_ws("customer_zip_code_prefix"), 5), F.lit("00000")).alias("zip_code"),
        *extra,
    )


def customer_aliases(raw: DataFrame, order: Sequence[str | Column] | None = None) -> DataFrame:
    """``(alias, survivor)`` of the customer ids that :func:`clean_customers` drops."""
    return aliases(raw, "customer_id", "customer_unique_id", _order(raw, order, ["customer_id"]))


def resolve_aliases(lines: DataFrame, found: DataFrame) -> DataFrame:
    """Lines of a dropped customer id under the id that was kept, so that the load finds its customer."""
    joined = lines.join(found, F.col("customer_id") == F.col("alias"), "left")
    own = F.coalesce("survivor", "customer_id").alias("customer_id")
    return joined.select(*[own if c == "customer_id" else F.col(c) for c in lines.columns])


# ----------------------------------------------------------------------------- orders


class OrderOutputs(NamedTuple):
    lines: DataFrame
    dim_date: DataFrame


def parse_times(
    df: DataFrame, columns: Sequence[str], formats: Sequence[str], mode: str = "each", order: Sequence[str | Column] = ()
) -> DataFrame:
    """Parse the time columns; bad values become null. With ``mode="infer"`` a column has the shape of
    its first non-null value by ``order`` (one aggregate, run when the plan is built)."""
    shapes = infer_time_shapes(df, {c: (F.col(c), order) for c in columns}) if mode == "infer" else {}
    read = lambda c: shape_timestamp(c, shapes.get(c), formats) if mode == "infer" else lenient_timestamp(c, formats)
    return df.select(*[read(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def parse_order_times(
    orders: DataFrame, formats: Sequence[str], mode: str = "each", order: Sequence[str | Column] | None = None
) -> DataFrame:
    """Parse each of the five order time columns that is present; bad values become null."""
    present = [c for c in ORDER_TIME_COLUMNS if c in orders.columns]
    return parse_times(orders, present, formats, mode, _order(orders, order, orders.columns))


def valid_status(orders: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """Keep rows whose status is in the allowed set; a null status is rejected."""
    return orders.where(F.col("order_status").isin(*statuses))


def rejected_status(orders: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """The reject side: ``(order_status, rows)`` per rejected value, null included."""
    rejected = orders.where(~F.coalesce(F.col("order_status").isin(*statuses), F.lit(False)))
    return rejected.groupBy("order_status").agg(F.count(F.lit(1)).alias("rows"))


def parse_items(items: DataFrame) -> DataFrame:
    """Lenient item numbers: 64-bit seq, 1 by default (truncated), price NaN/bad -> null, freight -> 0.0."""
    extra = [ORD] if ORD in items.columns else []
    return items.select(
        "order_id",
        lenient_int("order_item_id", 1).alias("order_item_id"),
        "product_id",
        lenient_double("price").alias("price"),
        lenient_double("freight_value", 0.0).alias("freight_value"),
        *extra,
    )


def parse_events(events: DataFrame, formats: Sequence[str], mode: str = "each") -> DataFrame:
    """Operational events with a parsed (lenient) event time and a numeric event id, so ids that
    arrive as text compare as the numbers they are. The ids also order the events where they have no
    ingest ordinal."""
    if "event_id" in events.columns:
        events = events.withColumn("event_id", F.col("event_id").try_cast("bigint"))
    fallback = ["event_id"] if "event_id" in events.columns else events.columns
    return parse_times(events, ["event_timestamp"], formats, mode, _order(events, None, fallback))


def join_order_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Inner join on ``order_id`` (1:n); orders without items vanish.

    When both sides carry an ingest ordinal the line ordinal is ``(order ordinal, item ordinal)``,
    the row order of the joined staging output.
    """
    has_ord = ORD in orders.columns and ORD in items.columns
    o = orders.withColumnRenamed(ORD, "_o_ord") if has_ord else orders
    i = items.withColumnRenamed(ORD, "_i_ord") if has_ord else items
    m = o.join(i, "order_id", "inner")
    if has_ord:
        m = m.withColumn(ORD, F.struct(F.col("_o_ord").alias("o"), F.col("_i_ord").alias("i"))).drop(
            "_o_ord", "_i_ord"
        )
    return m


def dim_date_from_lines(lines: DataFrame) -> DataFrame:
    """The date dimension of staged lines, from their ``date_key`` (distinct keys first: the
    partial aggregation leaves at most one row per day per input partition)."""
    keys = lines.select("date_key").where(F.col("date_key").isNotNull()).distinct()
    day = F.to_date(F.col("date_key").cast("string"), "yyyyMMdd")
    return keys.select(*dim_date_columns(day))


def dim_date_from_orders(orders: DataFrame, items: DataFrame, min_price: float) -> DataFrame:
    """The same dimension without the lines: the dates of orders that have an item above ``min_price``.
    A semi join needs an item's order id and price only and gives at most one row an order."""
    priced = items.select("order_id", lenient_double("price").alias("price")).where(F.col("price") > F.lit(min_price))
    dated = orders.select("order_id", "date_key").where(F.col("date_key").isNotNull())
    return dim_date_from_lines(dated.join(priced.select("order_id"), "order_id", "left_semi"))


def clean_orders(
    orders: DataFrame,
    items: DataFrame,
    events: DataFrame | None = None,
    params: Params = Params(),
    counters: Counters | None = None,
) -> OrderOutputs:
    """Order lines ready for the fact load, and the date dimension of the surviving lines.

    Steps: parse time columns; drop null ``order_id``/``customer_id``; keep allowed statuses;
    join items; keep ``price > min_price``; ``date_key`` from the purchase time (null stays null);
    optionally override the status with the latest operational event (applied after status
    validation, so an unknown event status reaches the load and gets a null status key).
    ``counters`` takes the rows dropped, rejected and enriched on the way.
    """
    o = parse_order_times(orders, params.timestamp_formats, params.timestamps)
    if counters is not None:
        keyed = F.col("order_id").isNotNull() & F.col("customer_id").isNotNull()
        allowed = F.coalesce(F.col("order_status").isin(*params.valid_statuses), F.lit(False))
        o = counters(o, "orders", raw=F.count(F.lit(1)), dropped=F.count_if(~keyed), rejected=F.count_if(keyed & ~allowed))
    o = drop_null_keys(o, ["order_id", "customer_id"])
    o = valid_status(o, params.valid_statuses)
    # Once an order, before the 1:n join; only the key travels on.
    o = o.withColumn("date_key", date_key("order_purchase_timestamp"))
    o = o.select("order_id", "customer_id", "order_status", "date_key", *([ORD] if ORD in o.columns else []))
    m = join_order_items(o, parse_items(items))
    if counters is not None:
        priced = F.coalesce(F.col("price") > F.lit(params.min_price), F.lit(False))
        m = counters(m, "lines", joined=F.count(F.lit(1)), dropped=F.count_if(~priced))
    m = m.where(F.col("price") > F.lit(params.min_price))
    if events is not None:
        ev = parse_events(events, params.timestamp_formats, params.timestamps)
        tiebreak = "event_id" if "event_id" in ev.columns else None
        m = apply_latest_status(m, latest_status(ev, tiebreak=tiebreak), counters=counters)
    extra = [ORD] if ORD in m.columns else []
    lines = m.select(
        "order_id",
        F.col("order_item_id").alias("order_item_seq"),
        "customer_id",
        "product_id",
        "date_key",
        "order_status",
        "price",
        "freight_value",
        F.lit(1).alias("quantity"),
        *extra,
    )
    return OrderOutputs(lines, dim_date_from_orders(o, items, params.min_price))


# ----------------------------------------------------------------------------- products


def clean_product_category(raw: DataFrame) -> DataFrame:
    """Drop null ids; category stripped, lower-cased, ``uncategorized`` when missing."""
    df = drop_null_keys(raw, ["product_id"])
    return df.withColumn(
        "product_category_name",
        F.coalesce(F.lower(strip_ws("product_category_name")), F.lit("uncategorized")),
    )


def clean_products(
    raw: DataFrame,
    enrichment: DataFrame | None = None,
    order: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Product dimension rows: mapped English label plus catalog averages, first row per id.

    ``enrichment`` is :func:`starloom.operators.enrich.api_enrichment` output, or ``None`` when
    the catalog is unavailable (averages are then 0.0).
    Output: ``product_id, category, name, api_price, api_rating`` (+ ``_ord`` if present).
    """
    df = clean_product_category(raw)
    df = df.withColumn("api_category", map_category(F.col("product_category_name")))
    df = join_enrichment(df, enrichment)
    extra = [ORD] if ORD in df.columns else []
    df = df.select(
        "product_id",
        F.col("product_category_name").alias("category"),
        F.col("api_category").alias("name"),
        F.col("avg_price").alias("api_price"),
        F.col("avg_rating").alias("api_rating"),
        *extra,
    )
    return keep_first(df, ["product_id"], _order(df, order, ["category", "name"]))
