"""Latest operational status per order and its override of the order status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.counters import Counters


def _event_order(ts: str, tiebreak: str | None, status: str) -> Column:
    """What makes an event later: no readable time, the time, the event id, the status text."""
    order = [F.col(ts).isNull().cast("int").alias("ts_missing"), F.col(ts).alias("ts")]
    if tiebreak is not None:
        order.append(F.col(tiebreak).alias("tiebreak"))
    order.append(F.col(status).alias("status_text"))
    return F.struct(*order)


def latest_status(
    events: DataFrame,
    key: str = "order_id",
    status: str = "status",
    ts: str = "event_timestamp",
    tiebreak: str | None = "event_id",
) -> DataFrame:
    """Latest non-null status per key by event time -> ``(key, latest_event_status)``.

    Semantics of sorting by time and taking each group's last value:
    * null statuses are skipped, so a later event without a status does not erase an earlier one;
    * events whose time is missing (unparseable) sort after every dated event, so they win;
    * ties on time go to the highest ``tiebreak`` (the event id), else the larger status string;
    * null keys are dropped.
    ``max_by`` keeps this a combinable aggregate: each task sends one row a key. (Its buffer is not of
    fixed width, so Spark aggregates by sorting within each task.)
    """
    kept = events.where(F.col(key).isNotNull() & F.col(status).isNotNull())
    latest = F.max_by(F.col(status), _event_order(ts, tiebreak, status))
    return kept.groupBy(key).agg(latest.alias("latest_event_status"))


STATUS_STATE_SCHEMA = (
    "order_id string, latest struct<ts_missing:int,ts:timestamp_ntz,tiebreak:bigint,status_text:string>"
)


def status_state(events: DataFrame) -> DataFrame:
    """The events of one load as state, one row an order (``STATUS_STATE_SCHEMA``): its latest event
    with a status, and all that decides which event is later. Events as of ``parse_events``."""
    kept = events.where(F.col("order_id").isNotNull() & F.col("status").isNotNull())
    order = _event_order("event_timestamp", "event_id", "status")
    return kept.groupBy("order_id").agg(F.max(order).alias("latest"))


def latest_from_state(state: DataFrame) -> DataFrame:
    """``(order_id, latest_event_status)`` of any union of states: the maximum of maxima, so loads may
    come in any order and late events need nothing read again. Over a state bucketed by ``order_id``
    this aggregate moves nothing."""
    latest = state.groupBy("order_id").agg(F.max("latest").alias("latest"))
    return latest.select("order_id", F.col("latest.status_text").alias("latest_event_status"))


def apply_latest_status(
    lines: DataFrame, latest: DataFrame, key: str = "order_id", counters: Counters | None = None
) -> DataFrame:
    """Overwrite ``order_status`` where an event status exists (left join; unmatched rows keep theirs)."""
    cols = lines.columns
    joined = lines.join(latest, key, "left")
    if counters is not None:
        joined = counters(joined, "events", enriched=F.count("latest_event_status"))
    return joined.select(
        *[
            F.coalesce(F.col("latest_event_status"), F.col("order_status")).alias("order_status")
            if c == "order_status"
            else F.col(c)
            for c in cols
        ]
    )
