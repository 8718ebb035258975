"""Analytical queries over the loaded star (what the star schema exists for)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Money is summed as an exact decimal: the result does not depend on summation order.
MONEY = "decimal(18,2)"


def revenue_by_month_category(star: Mapping[str, DataFrame]) -> DataFrame:
    """Revenue, lines and units by year, month and product label.

    Plan: facts meet ``dim_date`` through a broadcast (one row per day), are pre-aggregated to
    ``(year, month, product_key)`` with map-side combining, and only that small aggregate is
    joined to ``dim_product`` and rolled up to the label. A hot product or day is absorbed by
    the partial aggregation before any shuffle.
    """
    fact = star["fact_orders"].select("date_key", "product_key", "price", "quantity")
    days = F.broadcast(star["dim_date"].select("date_key", "year", "month"))
    by_product = (
        fact.join(days, "date_key")
        .groupBy("year", "month", "product_key")
        .agg(
            F.sum(F.col("price").cast(MONEY)).alias("revenue"),
            F.count(F.lit(1)).alias("lines"),
            F.sum("quantity").alias("units"),
        )
    )
    products = star["dim_product"].select("product_key", F.col("name").alias("category"))
    return (
        by_product.join(products, "product_key")
        .groupBy("year", "month", "category")
        .agg(
            F.sum("revenue").cast("double").alias("revenue"),
            F.sum("lines").cast("long").alias("lines"),
            F.sum("units").cast("long").alias("units"),
        )
    )
