"""Resolve staged order lines to fact rows through the dimension tables.

``resolve_fact_keys`` keeps the lines that load; ``tag_fact_lines`` keeps all lines and says of each
why it does not; ``resolve_fact_keys_skewed`` looks heavy hitters up without moving their lines.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.lookup import heavy_hitters, lookup_placed, lookup_skewed

ORD = "_ord"
# Staged lines that lie in buckets are hashed by this column: all lines of an order in one.
PLACED_BY = "order_id"


def fact_columns(extra: bool) -> list[Column]:
    """The fact columns of resolved lines, with the types of the fact table."""
    return [
        F.col("order_id"),
        F.col("order_item_seq").cast("long").alias("order_item_seq"),
        F.col("customer_key"),
        F.col("product_key"),
        F.col("date_key").cast("int").alias("date_key"),
        F.col("status_key"),
        F.coalesce(F.col("quantity").cast("int"), F.lit(1)).alias("quantity"),
        F.col("price").cast("double").alias("price"),
        F.coalesce(F.col("freight_value").cast("double"), F.lit(0.0)).alias("freight_value"),
        *([F.col(ORD)] if extra else []),
    ]


def resolve_fact_keys(
    lines: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_date: DataFrame,
    dim_status: DataFrame,
    buckets: int | None = None,
) -> DataFrame:
    """Natural -> surrogate lookups.

    * customer and product: inner joins, a miss drops the line;
    * date: the line needs a ``date_key`` that exists in ``dim_date`` (semi join, the foreign key);
    * status: left join, a miss keeps the line with a null ``status_key``.
    ``dim_status`` is bounded by the configured status list and ``dim_date`` by the number of
    calendar days, so both are broadcast; customer and product lookups are left to AQE (broadcast
    when small at run time, otherwise sort-merge with skew splitting). Lines that lie in ``buckets``
    by ``PLACED_BY`` stay there and only their keys move (:func:`starloom.operators.lookup.lookup_placed`).
    """
    customers = dim_customer.select("customer_id", "customer_key")
    products = dim_product.select("product_id", "product_key")
    days = F.broadcast(dim_date.select("date_key"))
    statuses = F.broadcast(dim_status.select(F.col("status_label").alias("order_status"), "status_key"))
    f = lines.where(F.col("date_key").isNotNull())
    if buckets is None:
        f = f.join(customers, "customer_id", "inner").join(products, "product_id", "inner")
    else:
        pairs = f = f.where(F.col("price").isNotNull())
        f = lookup_placed(f, pairs, customers, "customer_id", PLACED_BY, buckets)
        f = lookup_placed(f, pairs, products, "product_id", PLACED_BY, buckets)
    f = f.join(days, "date_key", "left_semi").join(statuses, "order_status", "left")
    return f.where(F.col("price").isNotNull()).select(*fact_columns(ORD in lines.columns))


# Why a line is not loaded, in the order in which the reasons are looked at.
REJECT_REASONS = ("customer", "product", "no_date", "date_not_in_dim", "price")


def _spread(key: str) -> Column:
    """The key, or a text of its own for a null one: nulls match nothing, but in an outer join they
    would all meet in one task."""
    return F.coalesce(F.col(key), F.concat(F.lit("\u0000"), F.xxhash64("order_id", "order_item_seq", "price").cast("string")))


def tag_fact_lines(
    lines: DataFrame, dim_customer: DataFrame, dim_product: DataFrame, dim_date: DataFrame, dim_status: DataFrame
) -> DataFrame:
    """Every line with its keys and ``reason``: null if the line loads, else the first that holds.

    * ``customer``, ``product``: the natural key is in no dimension row;
    * ``no_date``: no ``date_key`` (the purchase time was missing or unreadable);
    * ``date_not_in_dim``: the foreign key to ``dim_date`` fails;
    * ``price``: null, which the fact table does not take.
    An unknown status is no reason: the line loads with a null ``status_key``. One pass of outer lookups;
    ``dim_status`` and ``dim_date`` are bounded and broadcast as in :func:`resolve_fact_keys`.
    """
    customers = dim_customer.select(F.col("customer_id").alias("_ck"), "customer_key")
    products = dim_product.select(F.col("product_id").alias("_pk"), "product_key")
    days = F.broadcast(dim_date.select(F.col("date_key").alias("_dk"), F.lit(True).alias("_day")))
    statuses = F.broadcast(dim_status.select(F.col("status_label").alias("_sk"), "status_key"))
    f = lines.join(customers, _spread("customer_id") == F.col("_ck"), "left")
    f = f.join(products, _spread("product_id") == F.col("_pk"), "left")
    f = f.join(days, F.col("date_key") == F.col("_dk"), "left").join(statuses, F.col("order_status") == F.col("_sk"), "left")
    reason = (
        F.when(F.col("customer_key").isNull(), "customer")
        .when(F.col("product_key").isNull(), "product")
        .when(F.col("date_key").isNull(), "no_date")
        .when(F.col("_day").isNull(), "date_not_in_dim")
        .when(F.col("price").isNull(), "price")
    )
    return f.select(*lines.columns, "customer_key", "product_key", "status_key", reason.alias("reason"))


class RoutedLines(NamedTuple):
    facts: DataFrame
    rejects: DataFrame


REJECT_COLUMNS = ("order_id", "order_item_seq", "customer_id", "product_id", "date_key", "order_status", "price", "freight_value", "reason")


def route_fact_lines(tagged: DataFrame) -> RoutedLines:
    """Tagged lines (written once by the caller) to fact rows and to rejects with their reason."""
    facts = tagged.where(F.col("reason").isNull()).select(*fact_columns(ORD in tagged.columns))
    return RoutedLines(facts, tagged.where(F.col("reason").isNotNull()).select(*REJECT_COLUMNS))


def reason_counts() -> dict[str, Column]:
    """Aggregates over tagged lines: how many load, and how many are held back by each reason."""
    return {"accepted": F.count_if(F.col("reason").isNull())} | {r: F.count_if(F.col("reason") == r) for r in REJECT_REASONS}


def resolve_fact_keys_skewed(
    lines: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_date: DataFrame,
    dim_status: DataFrame,
    buckets: int | None = None,
) -> DataFrame:
    """The rows of :func:`resolve_fact_keys` where a few customers or products hold many lines: those
    are found by a sketch and looked up by broadcast, so their lines are not shuffled. Of lines that lie
    in ``buckets`` by ``PLACED_BY`` none are."""
    f = lines.where(F.col("date_key").isNotNull() & F.col("price").isNotNull())
    f = f.join(F.broadcast(dim_date.select("date_key")), "date_key", "left_semi")
    hot = heavy_hitters(lines, ["customer_id", "product_id"])
    pairs = f
    for dim, key, surrogate in ((dim_customer, "customer_id", "customer_key"), (dim_product, "product_id", "product_key")):
        found = dim.select(key, surrogate)
        if buckets is None:
            f = lookup_skewed(f, found, key, hot[key])
        else:
            f = lookup_placed(f, pairs, found, key, PLACED_BY, buckets, hot[key])
    f = f.join(F.broadcast(dim_status.select(F.col("status_label").alias("order_status"), "status_key")), "order_status", "left")
    return f.select(*fact_columns(ORD in lines.columns))
