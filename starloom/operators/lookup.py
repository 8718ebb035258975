"""Equi-join lookups that move little of the rows: of skewed keys heavy hitters by broadcast, the rest by
shuffle; of rows that lie hashed by another column only their keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys that the sketch reports and counters it keeps. The broadcast has at most TOP rows, whatever the data.
TOP, COUNTERS = 256, 10_000
# A key is hot with at least this share of the rows.
HOT_SHARE = 0.002


def heavy_hitters(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE, top: int = TOP) -> dict[str, list]:
    """For each key column the values that hold about ``share`` of the rows or more, at most ``top``.

    One aggregate of sketches, in which each task keeps ``COUNTERS`` counters a column; a null is no key.
    """
    sketches = [F.expr(f"approx_top_k(`{k}`, {top}, {COUNTERS})").alias(k) for k in keys]
    row = df.agg(*sketches, F.count(F.lit(1)).alias("__n")).first()
    least = max(share * row["__n"], 2)
    return {k: [r["item"] for r in row[k] or [] if r["item"] is not None and r["count"] >= least] for k in keys}


def lookup_skewed(rows: DataFrame, dim: DataFrame, key: str, hot: Sequence) -> DataFrame:
    """``rows`` inner join ``dim`` on ``key`` (unique in ``dim``), as one would by ``rows.join(dim, key)``.

    The rows of ``hot`` keys (:func:`heavy_hitters`) meet a broadcast of only their dimension rows and
    are not moved; the others are shuffled. A sketch that misses a key or names too many changes where
    rows are joined, never the result. ``rows`` are read for either part, so they should come from a
    written table.
    """
    if not hot:
        return rows.join(dim, key)
    is_hot = F.col(key).isin(list(hot))
    few = F.broadcast(dim.where(is_hot))
    return rows.where(is_hot).join(few, key).unionByName(rows.where(~is_hot).join(dim.where(~is_hot), key))


def lookup_placed(
    rows: DataFrame, pairs: DataFrame, dim: DataFrame, key: str, by: str, partitions: int, hot: Sequence = ()
) -> DataFrame:
    """``rows`` inner join ``dim`` on ``key``, where ``rows`` lie hashed by ``by`` (not null) in ``partitions``
    partitions, as a bucketed table does, and stay there.

    What moves are the distinct ``(by, key)`` of ``pairs`` (the rows as they are stored, so that a chain of
    lookups does not compute the earlier ones again): to the dimension, unless that is broadcast, and
    back to the place of ``by`` with what was found. ``hot`` keys (:func:`heavy_hitters`) meet a broadcast of
    only their dimension rows, so that none of their pairs meet in one task either.

    Spark hashes both sides of a join anew by all its equal keys, so only ``by`` is one and ``key`` is compared
    as a range: a row meets all keys of its ``by``, which should be few (the products of an order).
    """
    is_hot = F.col(key).isin(list(hot)) if hot else F.lit(False)
    values = [c for c in dim.columns if c != key]
    cold = pairs.select(by, key).where(~is_hot).distinct().join(dim.where(~is_hot), key)
    found = cold.select(F.col(by).alias("_by"), F.col(key).alias("_key"), F.struct(*values).alias("_found"))
    same = (F.col(by) == F.col("_by")) & F.col(key).between(F.col("_key"), F.col("_key"))
    joined = rows.join(found.repartition(partitions, "_by"), same, "left" if hot else "inner")
    value = F.col("_found")
    if hot:
        few = F.broadcast(dim.where(is_hot).select(key, F.struct(*values).alias("_few")))
        value = F.coalesce("_few", "_found")
        joined = joined.join(few, key, "left").where(value.isNotNull())
    return joined.select(*[F.col(c) for c in rows.columns], *[value[c].alias(c) for c in values])
