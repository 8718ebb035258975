"""The data-quality gate over a loaded star: 14 checks as one small DataFrame.

The checks share their passes over the tables (see :func:`quality_checks`); only the 14 result rows
ever reach the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.frames import rows_frame
from starloom.operators.counters import unpivot_counts
from starloom.params import Params

PASS, FAIL, WARN = "PASS", "FAIL", "WARN"
ROW_COUNT_TABLES = ("fact_orders", "dim_customer", "dim_product", "dim_date", "dim_status")
NULL_FK_COLUMNS = ("customer_key", "product_key", "date_key")
ORPHAN_CHECKS = (
    ("customer_key", "dim_customer"),
    ("product_key", "dim_product"),
    ("date_key", "dim_date"),
    ("status_key", "dim_status"),
)


def thousands(n: Column) -> Column:
    """Integer with thousands separators (``{:,}``)."""
    return F.format_number(n.cast("long"), 0)


def percent_text(num: Column, den: Column, decimals: int) -> Column:
    """``num/den`` as a percentage text with ``decimals`` places, rounded half-up on the exact ratio.

    Integer division keeps the text identical on every engine (float formatting differs at
    half-way points between engines) and exact for any count.
    """
    div = lambda a, b: F.call_function("div", a, b)
    num, den = num.cast("decimal(28,0)"), den.cast("decimal(20,0)")
    scaled = F.when(den > 0, div(num * F.lit(2 * 10 ** (decimals + 2)) + den, den * 2)).otherwise(F.lit(0)).cast("long")
    unit = F.lit(10**decimals).cast("long")
    whole = div(scaled, unit)
    frac = F.lpad((scaled % unit).cast("string"), decimals, "0")
    return F.concat(whole.cast("string"), F.lit("."), frac, F.lit("%"))


def fact_metrics(fact: DataFrame) -> DataFrame:
    """``(metric, n)`` of the fact table's own columns, in one pass: rows, null keys, bad prices."""
    aggs = [F.count(F.lit(1)).alias("rows_fact_orders")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in NULL_FK_COLUMNS]
    aggs.append(F.count_if(F.col("price") <= 0).alias("bad_price"))
    return unpivot_counts(fact.agg(*aggs)).toDF("metric", "n")


def key_counts(fact: DataFrame) -> DataFrame:
    """``(column, key, n)``: how often each key occurs, in one fact pass. The four keys of a row become
    four pairs that are counted before any shuffle (a hot key is one row a task)."""
    pair = lambda c: F.struct(F.lit(c).alias("column"), F.col(c).cast("long").alias("key"))
    pairs = fact.select(F.inline(F.array(*[pair(c) for c, _ in ORPHAN_CHECKS]))).where("key IS NOT NULL")
    return pairs.groupBy("column", "key").agg(F.count(F.lit(1)).alias("n"))


def orphans_of(used: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """``(metric, n)``: rows of the counted keys that no dimension row has; only distinct keys meet the dimensions."""
    known = _union([dims[d].select(F.lit(c).alias("column"), F.col(c).cast("long").alias("key")) for c, d in ORPHAN_CHECKS])
    orphans = used.join(known, ["column", "key"], "left_anti").groupBy("column").agg(F.sum("n").alias("n"))
    return orphans.select(F.concat(F.lit("orphan_"), "column").alias("metric"), "n")


def orphan_metrics(star: Mapping[str, DataFrame]) -> DataFrame:
    """``(metric, n)``: rows whose non-null key is missing from its dimension, in one fact pass."""
    return orphans_of(key_counts(star["fact_orders"]), star)


def count_metric(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.lit(name).alias("metric"), F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# Check names and detail texts, as a reader of the reports knows them.
# ---------------------------------------------------------------------------
def _checks(params: Params, staged: bool) -> list[Column]:
    """The 14 checks as structs over one row of metrics."""

    def row(seq: int, check: str, status: Column, detail: Column, value: Column, total: Column) -> Column:
        return F.struct(
            F.lit(seq).alias("seq"),
            F.lit(check).alias("check"),
            status.alias("status"),
            detail.alias("detail"),
            value.cast("long").alias("value"),
            total.cast("long").alias("total"),
        )

    checks = []
    for i, table in enumerate(ROW_COUNT_TABLES):
        n = F.col(f"rows_{table}")
        checks.append(
            row(1 + i, f"row_count_{table}", F.when(n > 0, PASS).otherwise(FAIL), F.concat(thousands(n), F.lit(" rows")), n, n)
        )
    total = F.col("rows_fact_orders")
    for i, c in enumerate(NULL_FK_COLUMNS):
        nulls = F.col(f"null_{c}")
        ratio = F.when(total > 0, nulls / total).otherwise(F.lit(0.0))
        status = F.when(ratio <= F.lit(params.max_null_ratio_fact_fk), PASS).otherwise(FAIL)
        detail = F.concat(thousands(nulls), F.lit(" nulls ("), percent_text(nulls, total, 2), F.lit(")"))
        checks.append(row(6 + i, f"null_fk_{c}", status, detail, nulls, total))
    bad = F.col("bad_price")
    detail = F.concat(thousands(bad), F.lit(" rows with price ≤ 0"))
    checks.append(row(9, "price_positive", F.when(bad == 0, PASS).otherwise(FAIL), detail, bad, total))
    for i, (c, _) in enumerate(ORPHAN_CHECKS):
        n = F.col(f"orphan_{c}")
        detail = F.concat(thousands(n), F.lit(" orphan references"))
        checks.append(row(10 + i, f"orphan_fk_{c}", F.when(n == 0, PASS).otherwise(FAIL), detail, n, n))
    lines = F.col("staged")
    if not staged:
        checks.append(row(14, "staging_vs_fact", F.lit(WARN), F.lit("Staging file not found"), F.lit(None), F.lit(None)))
    else:
        ratio = F.when(lines > 0, total / lines)
        status = F.when(F.coalesce(ratio >= F.lit(params.min_load_ratio), F.lit(False)), PASS).otherwise(WARN)
        text = F.concat(
            thousands(total), F.lit("/"), thousands(lines), F.lit(" staging rows loaded ("), percent_text(total, lines, 1), F.lit(")")
        )
        detail = F.when(lines == 0, F.lit("Staging file is empty")).otherwise(text)
        checks.append(row(14, "staging_vs_fact", status, detail, total, lines))
    return checks


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quality_checks(
    star: Mapping[str, DataFrame], staged_lines: DataFrame | None, params: Params = Params()
) -> DataFrame:
    """All 14 checks: ``(seq, check, status, detail, value, total)``.

    Every number is first a row of ``(metric, n)``: the fact table is read twice (its own columns;
    its keys against the dimensions), every other table once for its count and the dimensions once
    more for their keys. The metrics, some twenty rows, are turned into one row and that into 14.
    """
    dims = [t for t in ROW_COUNT_TABLES if t != "fact_orders"]
    parts = [fact_metrics(star["fact_orders"]), orphan_metrics(star)]
    parts += [count_metric(star[t], f"rows_{t}") for t in dims]
    if staged_lines is not None:
        parts.append(count_metric(staged_lines, "staged"))
    return checks_of_metrics(parts, staged_lines is not None, params)


def checks_of_metrics(parts: list[DataFrame], staged: bool, params: Params) -> DataFrame:
    """Frames of ``(metric, n)`` to the 14 checks; a metric that is not there is 0."""
    names = [f"rows_{t}" for t in ROW_COUNT_TABLES] + [f"null_{c}" for c in NULL_FK_COLUMNS] + ["bad_price"]
    names += [f"orphan_{c}" for c, _ in ORPHAN_CHECKS] + ["staged"]
    wide = [F.coalesce(F.max(F.when(F.col("metric") == m, F.col("n"))), F.lit(0)).alias(m) for m in names]
    return _union(parts).agg(*wide).select(F.inline(F.array(*_checks(params, staged))))


def icon(status: Column) -> Column:
    return F.when(status == PASS, "✓").when(status == WARN, "⚠").otherwise("✗")


def report_lines(results: DataFrame) -> DataFrame:
    """One text line per check plus the totals line: ``(seq, line)``."""
    per_check = results.select(
        F.col("seq"),
        F.format_string("  [%-4s] %s  %-30s  %s", "status", icon(F.col("status")), "check", "detail").alias("line"),
    )
    totals = results.agg(
        F.lit(100).alias("seq"),
        F.format_string(
            "  Total: %d checks | %d FAILED | %d WARNINGS",
            F.count(F.lit(1)),
            F.count_if(F.col("status") == FAIL),
            F.count_if(F.col("status") == WARN),
        ).alias("line"),
    )
    return per_check.unionByName(totals)


def summary_counts(results: DataFrame) -> DataFrame:
    """``(checks, failures, warnings)`` tally."""
    return results.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("status") == FAIL).alias("failures"),
        F.count_if(F.col("status") == WARN).alias("warnings"),
    )


def write_report(results: DataFrame, report_root: str, run_ts: dt.datetime) -> str:
    """Append the results (with ``run_ts``) as Parquet and write the text report; returns its path."""
    stamp = run_ts.strftime("%Y%m%d_%H%M%S")
    results.withColumn("run_ts", F.lit(run_ts).cast("timestamp")).write.mode("append").parquet(
        f"{report_root}/results"
    )
    path = f"{report_root}/quality_{stamp}"
    rule = "=" * 60
    spark: SparkSession = results.sparkSession
    head = rows_frame(
        spark, [(-3, rule), (-2, f"  ETL Data Quality Report — {run_ts:%Y-%m-%d %H:%M:%S}"), (-1, rule)], "seq int, line string"
    )
    tail = rows_frame(spark, [(99, rule), (101, rule)], "seq int, line string")
    # 14 check lines plus a few fixed lines: a single output file is fine.
    lines = head.unionByName(report_lines(results)).unionByName(tail)
    lines.coalesce(1).sortWithinPartitions("seq").select("line").write.mode("overwrite").text(path)
    return path


def run_quality_gate(
    star: Mapping[str, DataFrame],
    staged_lines: DataFrame | None,
    params: Params = Params(),
    report_root: str | None = None,
    run_ts: dt.datetime | None = None,
    checks: DataFrame | None = None,
) -> dict:
    """Run the checks (or take ``checks``, already planned), write the report first, then raise ``ValueError`` if any check FAILed.

    WARN never stops the pipeline. Returns ``{results, failures, warnings, report_path}``.
    """
    run_ts = run_ts or dt.datetime.now()
    results_df = (quality_checks(star, staged_lines, params) if checks is None else checks).cache()
    try:
        rows = sorted(results_df.collect(), key=lambda r: r["seq"])
        report_path = write_report(results_df, report_root, run_ts) if report_root else None
    finally:
        results_df.unpersist()
    results = [{"check": r["check"], "status": r["status"], "detail": r["detail"]} for r in rows]
    failures = sum(r["status"] == FAIL for r in results)
    warnings = sum(r["status"] == WARN for r in results)
    if failures:
        raise ValueError(
            f"Data quality check FAILED: {failures} check(s) failed. See report: {report_path}"
        )
    return {"results": results, "failures": failures, "warnings": warnings, "report_path": report_path}
