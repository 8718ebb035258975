"""Connected components of an edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import materialize


def _done(edges: DataFrame) -> bool:
    """Whether every node points to one root and no root points on."""
    ends = edges.select(F.col("u").alias("k"), F.lit(1).alias("out"), F.lit(0).alias("root")).unionByName(
        edges.select(F.col("v").alias("k"), F.lit(0).alias("out"), F.lit(1).alias("root"))
    )
    seen = ends.groupBy("k").agg(F.sum("out").alias("out"), F.max("root").alias("root"))
    return seen.where("out > 1 OR (out = 1 AND root = 1)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    out = both.join(least, "u").where(F.col("v") > F.col("u"))
    return out.select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point from the larger node u to a smaller v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(kept).distinct()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``edges`` (u, v) of any orderable type -> (node, root): every node with an edge, with the
    smallest node of its component. Nulls and self edges are ignored; nothing is collected; rounds grow with the logarithm of the longest chain."""
    e = (
        edges.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    e = materialize(e, f"{label}-0")
    n = 1
    while not _done(e):
        e = materialize(_small_star(_large_star(e)), f"{label}-{n}")
        n += 1
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots).distinct()
