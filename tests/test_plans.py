"""Plan shape: no Python UDFs, filters reach the scan, bounded dims are broadcast,
surrogate keys do not funnel rows through a single-partition window."""


import pytest
from pyspark.sql import functions as F

from starloom.operators.keys import assign_surrogate_keys
from starloom.plans import catalog

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["order_facts", "product_dim", "customer_dim", "latest_status", "star_revenue"])
def test_no_python_udf(spark, name):
    p = plan(catalog.QUERIES[name](spark, SF))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_projection_and_filter_reach_parquet(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet").where(F.col("l_quantity") > 10).select("l_orderkey")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in p


def test_status_lookup_is_broadcast(spark):
    star, staged = catalog.loaded_star(spark, SF)
    from starloom.operators.facts import resolve_fact_keys

    rows = resolve_fact_keys(staged.lines, star["dim_customer"], star["dim_product"], star["dim_date"], star["dim_status"])
    assert "BroadcastHashJoin" in plan(rows)


def test_surrogate_keys_without_single_partition_window(spark):
    df = spark.range(0, 5000, numPartitions=8).select((F.col("id") * 7 % 5000).cast("string").alias("k"))
    keyed = assign_surrogate_keys(df, "sk", ["k"])
    assert "SinglePartition" not in plan(keyed) and "Window" not in plan(keyed)
    got = [r.k for r in keyed.orderBy("sk").collect()]
    assert got == sorted(got) and keyed.agg(F.min("sk"), F.max("sk")).first() == (1, 5000)


@pytest.mark.parametrize(
    "name, partial",
    [("latest_status", "partial_max_by"), ("dedup_first", "partial_min_by"), ("customer_dim", "partial_min_by")],
)
def test_hot_keys_are_combined_map_side(spark, name, partial):
    """A key holding a third of all rows is reduced before the shuffle: partial aggregation, no window."""
    p = plan(catalog.QUERIES[name](spark, SF))
    assert partial in p and "Window" not in p


def test_revenue_pre_aggregates_before_product_join(spark):
    p = catalog.QUERIES["star_revenue"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    # The aggregate by (year, month, product_key) sits below the join with the product dimension.
    inner = p[p.index("Join Inner"):]
    assert "Aggregate [year" in inner and "product_key" in inner
