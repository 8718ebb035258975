"""Keep one row per key, chosen by an explicit total order.

Written as ``groupBy(key).agg(min_by(struct(row), order))`` rather than a ``row_number`` window:
the aggregate combines map-side, so a key holding a third of all rows is reduced to one row
per input partition before the shuffle instead of being sorted in a single task. (Spark sorts within
each task for this aggregate, since a row is not a buffer of fixed width.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], last: bool) -> DataFrame:
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    if not order_cols:
        raise ValueError("an order is required to decide which row is first")
    rank = F.struct(*order_cols) if len(order_cols) > 1 else order_cols[0]
    row = F.struct(*[F.col(c) for c in others])
    chosen = (F.max_by if last else F.min_by)(row, rank).alias("_row")
    picked = df.groupBy(*keys).agg(chosen)
    return picked.select(*[F.col(k) for k in keys], *[F.col("_row")[c].alias(c) for c in others]).select(
        *df.columns
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """``drop_duplicates(keep='first')`` where ``order`` defines input order (must be unique per key)."""
    return _pick(df, keys, order, last=False)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Last row per key in ``order`` (sequential upserts of a batch: the last one sticks)."""
    return _pick(df, keys, order, last=True)


def aliases(df: DataFrame, key: str, group: str, order: Sequence[str | Column]) -> DataFrame:
    """``(alias, survivor)``: each ``key`` whose row :func:`keep_first` by ``group`` drops, with the key that
    is kept of its group. A key that some group keeps is no alias; one in several groups goes to that of
    its first row by ``order``. Null keys and groups take no part.
    """
    rows = df.where(F.col(key).isNotNull() & F.col(group).isNotNull())
    rank = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    kept = rows.groupBy(group).agg(F.min_by(key, rank).alias("survivor"))
    own = rows.groupBy(key).agg(F.min_by(group, rank).alias(group))
    found = own.join(kept, group).select(F.col(key).alias("alias"), "survivor").where("alias != survivor")
    return found.join(kept.select(F.col("survivor").alias("alias")), "alias", "left_anti")
