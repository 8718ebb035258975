"""End to end with step selection; a second run is idempotent."""

import datetime as dt
import os

from starloom.params import Params
from starloom.plans.pipeline import PipelineConfig, run_pipeline
from starloom.sources.warehouse import read_star


def _checkpoints(spark):
    return spark.sparkContext.getCheckpointDir().removeprefix("file:")


def test_end_to_end_twice(spark, fixture_dir, tmp_path):
    cfg = PipelineConfig(
        sources={
            "customers": f"{fixture_dir}/customers.csv",
            "orders": f"{fixture_dir}/orders.csv",
            "order_items": f"{fixture_dir}/order_items.csv",
            "products": f"{fixture_dir}/products.csv",
        },
        api_products=f"{fixture_dir}/api_products.json",
        order_events=f"{fixture_dir}/order_events.csv",
        raw_root=str(tmp_path / "raw"),
        staging_root=str(tmp_path / "staging"),
        warehouse_root=str(tmp_path / "wh"),
        report_root=str(tmp_path / "reports"),
    )
    r1 = run_pipeline(spark, cfg, Params(), dt.datetime(2024, 1, 1))
    assert r1.steps == ["extract", "transform", "load", "quality"]
    assert r1.raw_rows == {"customers": 6, "orders": 8, "order_items": 10, "products": 7, "api_records": 6, "order_events": 10}
    assert r1.staged_rows == {"orders_clean": 8, "customers_clean": 4, "products_clean": 6, "dim_date": 4}
    assert r1.rows == {"dim_date": 4, "dim_status": 8, "dim_customer": 4, "dim_product": 6, "fact_orders": 5}
    assert r1.quality["failures"] == 0
    r2 = run_pipeline(spark, cfg, Params(), dt.datetime(2024, 1, 2), steps=("load", "quality"))
    assert r2.version == 2 and r2.rows == r1.rows
    assert r1.counters == {
        "customers_raw": 6, "customers_dropped": 1, "orders_raw": 8, "orders_dropped": 1, "orders_rejected": 1,
        "lines_joined": 10, "lines_dropped": 2, "events_enriched": 6, "products_raw": 7, "products_dropped": 0,
        "catalog_raw": 6, "catalog_dropped": 1, "facts_inserted": 5, "facts_skipped": 3,
    }
    assert r2.counters == {"facts_inserted": 0, "facts_skipped": 8}
    left = [f for f in os.listdir(_checkpoints(spark)) if f.startswith("starloom-run-")]
    assert left == []  # the loads' temporary copies are gone
    star = read_star(spark, cfg.warehouse_root)
    assert {r.status_key for r in star["fact_orders"].collect()} == {None, 1, 2}
