"""The quality gate kept between loads: what a load adds is measured once, the gate sums measures.

A load's measures are its rows, null keys and bad prices, and how often each of its keys occurs (one
row a distinct key). They never change, as facts do not. The gate adds them up and checks the summed
keys against the dimensions as they are now, so it sees a dimension row that was removed since, and
reads no fact but those of the loads not yet measured.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.quality import (
    ROW_COUNT_TABLES,
    checks_of_metrics,
    count_metric,
    fact_metrics,
    key_counts,
    orphans_of,
)
from starloom.params import Params

# ``metric``: a number of the load; ``column`` and ``key``: a key that its facts hold ``n`` times.
MEASURES_SCHEMA = "metric string, `column` string, key long, n long"


def load_measures(facts: DataFrame) -> DataFrame:
    """``MEASURES_SCHEMA`` of the facts one load has added; written once with the load."""
    own = fact_metrics(facts).select("metric", F.lit(None).cast("string").alias("column"), F.lit(None).cast("long").alias("key"), "n")
    keys = key_counts(facts).select(F.lit("key").alias("metric"), "column", "key", "n")
    return own.unionByName(keys)


def merged_measures(measures: DataFrame) -> DataFrame:
    """The measures of several loads as those of one."""
    return measures.groupBy("metric", "column", "key").agg(F.sum("n").alias("n"))


def incremental_quality_checks(
    measures: DataFrame, dims: Mapping[str, DataFrame], staged_lines: DataFrame | None, params: Params = Params()
) -> DataFrame:
    """The 14 checks of :func:`starloom.operators.quality.quality_checks` from the measures of all loads.

    Facts are not read; distinct keys of all loads meet the dimensions once.
    """
    numbers = measures.where(F.col("metric") != "key").groupBy("metric").agg(F.sum("n").alias("n"))
    used = measures.where(F.col("metric") == "key").groupBy("column", "key").agg(F.sum("n").alias("n"))
    parts = [numbers, orphans_of(used, dims)]
    parts += [count_metric(dims[t], f"rows_{t}") for t in ROW_COUNT_TABLES if t != "fact_orders"]
    if staged_lines is not None:
        parts.append(count_metric(staged_lines, "staged"))
    return checks_of_metrics(parts, staged_lines is not None, params)
