"""Row-level operators of the pipeline, each a function of DataFrames."""

from starloom.operators.clean import clean_customers, clean_orders, clean_products
from starloom.operators.dedup import keep_first, keep_last
from starloom.operators.enrich import api_enrichment, map_category
from starloom.operators.facts import resolve_fact_keys
from starloom.operators.keys import assign_surrogate_keys
from starloom.operators.latest import apply_latest_status, latest_status
from starloom.operators.merge import append_once, insert_new, scd1_merge
from starloom.operators.quality import quality_checks, run_quality_gate

__all__ = [
    "api_enrichment",
    "append_once",
    "apply_latest_status",
    "assign_surrogate_keys",
    "clean_customers",
    "clean_orders",
    "clean_products",
    "insert_new",
    "keep_first",
    "keep_last",
    "latest_status",
    "map_category",
    "quality_checks",
    "resolve_fact_keys",
    "run_quality_gate",
    "scd1_merge",
]
