"""Step counters: rows in, dropped and kept at each step."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Counters:
    """Named counts taken while the plan runs for another purpose (no second pass).

    ``counters(df, "orders", dropped=...)`` returns ``df`` with the aggregates attached;
    :meth:`values` reads them after the action that ran it.
    """

    def __init__(self) -> None:
        self._observed: dict[str, Observation] = {}

    def __call__(self, df: DataFrame, name: str, **aggregates: Column) -> DataFrame:
        obs = Observation(f"{name}_{uuid.uuid4().hex[:8]}")
        self._observed[name] = obs
        return df.observe(obs, *[a.alias(k) for k, a in aggregates.items()])

    def values(self) -> dict[str, int]:
        return {f"{name}_{k}": int(v or 0) for name, obs in self._observed.items() for k, v in obs.get.items()}


def unpivot_counts(row: DataFrame) -> DataFrame:
    """A one-row frame of counts as ``(step, rows)``."""
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("step"), F.col(c).cast("long").alias("rows")) for c in row.columns])))


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as a side effect of whatever action runs the plan (no second pass).

    Read ``observation.get['rows']`` after that action (e.g. after the write).
    """
    obs = Observation(f"{name}_{uuid.uuid4().hex[:8]}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
