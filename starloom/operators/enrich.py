"""Product category mapping and the per-category enrichment from the product catalog API."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Source (Portuguese) product category -> catalog (English) label.
# Any other category, including "uncategorized", maps to the default label "electronics".
# ---------------------------------------------------------------------------
CATEGORY_MAP: dict[str, str] = {
    "eletronicos": "electronics",
    "informatica_acessorios": "electronics",
    "telefonia": "electronics",
    "tablets_impressao_imagem": "electronics",
    "audio": "electronics",
    "eletrodomesticos": "electronics",
    "eletrodomesticos_2": "electronics",
    "utilidades_domesticas": "electronics",
    "cama_mesa_banho": "women's clothing",
    "fashion_bolsas_e_acessorios": "women's clothing",
    "fashion_roupa_feminina": "women's clothing",
    "fashion_roupa_masculina": "men's clothing",
    "fashion_calcados": "men's clothing",
    "fashion_underwear_e_moda_praia": "men's clothing",
    "fashion_esporte": "men's clothing",
    "joias_relogios": "jewelery",
    "relogios_presentes": "jewelery",
    "bijuterias_e_jóias": "jewelery",
}
DEFAULT_LABEL = "electronics"

# Every label a product can be mapped to: the enrichment join never needs more rows than this.
LABELS: tuple[str, ...] = tuple(sorted(set(CATEGORY_MAP.values()) | {DEFAULT_LABEL}))


def map_category(category: Column) -> Column:
    """Exact dictionary lookup with the default label for anything unmapped."""
    pairs = []
    for k, v in CATEGORY_MAP.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), category), F.lit(DEFAULT_LABEL))


def api_enrichment(api_products: DataFrame) -> DataFrame:
    """Mean price and rating per catalog category -> ``(api_category, avg_price, avg_rating)``.

    Expects the flattened records of :func:`starloom.sources.json_records.flatten_api_products`.
    Empty input gives an empty frame of the same schema.
    """
    return api_products.groupBy("api_category").agg(
        F.avg("price").alias("avg_price"), F.avg("rating").alias("avg_rating")
    )


def join_enrichment(products: DataFrame, enrichment: DataFrame | None) -> DataFrame:
    """Attach ``avg_price``/``avg_rating`` by ``api_category``; missing -> 0.0.

    Every product maps to one of ``LABELS`` (four values), so the enrichment is first narrowed to
    those labels: the side joined is at most four rows whatever the catalog size, and is
    broadcast. This avoids shuffling products on a four-valued (maximally skewed) key.
    """
    if enrichment is None:
        return products.withColumn("avg_price", F.lit(0.0)).withColumn("avg_rating", F.lit(0.0))
    small = enrichment.where(F.col("api_category").isin(*LABELS))
    joined = products.join(F.broadcast(small), "api_category", "left")
    return joined.withColumn("avg_price", F.coalesce(F.col("avg_price"), F.lit(0.0))).withColumn(
        "avg_rating", F.coalesce(F.col("avg_rating"), F.lit(0.0))
    )
