"""Quality gate: 14 checks, WARN never fails, FAIL raises after the report is written."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from starloom.operators.quality import quality_checks, run_quality_gate
from starloom.params import Params
from starloom.plans.star import empty_star, load_star, materialize, transform

T1 = dt.datetime(2024, 1, 1)


@pytest.fixture()
def loaded(raw):
    staged = transform(raw, Params())
    star, _ = load_star(None, staged, Params(), T1)
    return materialize(star), staged


def by_check(df):
    return {r["check"]: (r["status"], r["detail"]) for r in df.collect()}


def test_fourteen_checks_and_warn_ratio(loaded):
    star, staged = loaded
    res = by_check(quality_checks(star, staged.lines, Params()))
    assert len(res) == 14
    assert res["row_count_fact_orders"] == ("PASS", "5 rows")
    assert res["null_fk_customer_key"] == ("PASS", "0 nulls (0.00%)")
    assert res["price_positive"] == ("PASS", "0 rows with price ≤ 0")
    assert res["orphan_fk_status_key"] == ("PASS", "0 orphan references")
    assert res["staging_vs_fact"] == ("WARN", "5/8 staging rows loaded (62.5%)")


def test_gate_passes_with_warnings_and_writes_report(loaded, tmp_path):
    star, staged = loaded
    out = run_quality_gate(star, staged.lines, Params(), str(tmp_path / "reports"), T1)
    assert out["failures"] == 0 and out["warnings"] == 1
    assert os.path.isdir(out["report_path"])
    text = "".join(open(os.path.join(out["report_path"], f), encoding="utf-8").read()
                   for f in os.listdir(out["report_path"]) if f.startswith("part-"))
    assert "Total: 14 checks | 0 FAILED | 1 WARNINGS" in text


def test_empty_star_fails(spark, tmp_path):
    with pytest.raises(ValueError, match="Data quality check FAILED"):
        run_quality_gate(empty_star(spark), None, Params(), str(tmp_path / "r"), T1)


def test_orphans_and_null_ratio_fail(loaded):
    star, staged = loaded
    bad = dict(star)
    bad["dim_product"] = star["dim_product"].where(F.col("product_key") != 2)
    bad["fact_orders"] = star["fact_orders"].withColumn(
        "customer_key", F.when((F.col("order_id") == "r12") & (F.col("order_item_seq") == 1), F.lit(None)).otherwise(F.col("customer_key"))
    )
    res = by_check(quality_checks(bad, staged.lines, Params()))
    assert res["orphan_fk_product_key"] == ("FAIL", "1 orphan references")
    assert res["null_fk_customer_key"] == ("FAIL", "1 nulls (20.00%)")
    lenient = by_check(quality_checks(bad, staged.lines, Params(max_null_ratio_fact_fk=0.20)))
    assert lenient["null_fk_customer_key"][0] == "PASS"  # ratio equal to the threshold passes


def test_missing_staging_warns(loaded):
    star, _ = loaded
    res = by_check(quality_checks(star, None, Params()))
    assert res["staging_vs_fact"] == ("WARN", "Staging file not found")


def test_load_ratio_boundary(spark, loaded):
    star, _ = loaded
    # 5 loaded of 7 staged = 71.4% passes, of 8 = 62.5% warns.
    assert by_check(quality_checks(star, spark.range(0, 7), Params()))["staging_vs_fact"][0] == "PASS"
    assert by_check(quality_checks(star, spark.range(0, 8), Params()))["staging_vs_fact"][0] == "WARN"
    assert by_check(quality_checks(star, spark.range(0, 0), Params()))["staging_vs_fact"] == ("WARN", "Staging file is empty")


def test_the_gate_reads_the_facts_twice(spark, tmp_path):
    """Own columns in one pass, keys against the dimensions in another."""
    from starloom.schemas import STAR_SCHEMAS

    star = {}
    for t, df in empty_star(spark).items():
        df.write.parquet(f"{tmp_path}/{t}")
        star[t] = spark.read.schema(STAR_SCHEMAS[t]).parquet(f"{tmp_path}/{t}")
    plan = quality_checks(star, spark.range(3), Params())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [fact_id") == 2
