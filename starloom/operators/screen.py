"""Insert-once with a screen: which rows of a batch can have been loaded before, without reading the facts.

Every load leaves bitmaps of its keys' hashes, one bit a key, in slots of 32,768 bits
(``bitmap_construct_agg``). A key whose bit no load has set is new for certain; a set bit may be a
false alarm, so only the rows with a hit are compared with the facts, and only with those loads that
hit. Bitmaps take ``BITS_A_KEY`` bits a key or more; with 16 about 6 % of new keys are false alarms.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOT_BITS = 32_768  # fixed by Spark's bitmap functions
BITS_A_KEY = 16
SCREEN_SCHEMA = "slot long, bits binary, slots long"


def slots_for(rows: int) -> int:
    """A power of two of slots that gives ``rows`` keys their bits; a load's choice is kept with it."""
    return 1 << max(0, math.ceil(math.log2(max(1, rows * BITS_A_KEY / SLOT_BITS))))


def _place(keys: Sequence[str], slots: Column | int) -> Column:
    """A key's bit among ``slots`` slots. Fewer slots are a prefix of the hash's low bits."""
    slots = F.lit(slots) if isinstance(slots, int) else slots
    return F.pmod(F.xxhash64(*keys), (slots * SLOT_BITS).cast("long"))


def key_bitmaps(rows: DataFrame, keys: Sequence[str], slots: int) -> DataFrame:
    """``SCREEN_SCHEMA``: the bitmaps of one load's keys; at most 4 KB a slot leaves a task."""
    at = _place(keys, slots)
    return (
        rows.groupBy(F.floor(at / SLOT_BITS).cast("long").alias("slot"))
        .agg(F.bitmap_construct_agg(F.pmod(at, F.lit(SLOT_BITS))).alias("bits"))
        .withColumn("slots", F.lit(slots).cast("long"))
    )


def _bit(bits: Column, place: Column) -> Column:
    """Whether the bit at ``place`` is set."""
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1


def may_be_among(rows: DataFrame, bitmaps: DataFrame, slots: int, keys: Sequence[str]) -> DataFrame:
    """``rows`` without those whose key certainly is not among the keys of ``bitmaps`` (:func:`key_bitmaps`
    with ``slots``), which are broadcast; a few others stay as false alarms. No row is moved."""
    screen = F.broadcast(bitmaps.select(F.col("slot").alias("__slot"), F.col("bits").alias("__bits")))
    at = _place(keys, slots)
    found = rows.join(screen, F.floor(at / SLOT_BITS).cast("long") == F.col("__slot"))
    return found.where(_bit(F.col("__bits"), F.pmod(at, F.lit(SLOT_BITS)))).select(*rows.columns)


def screened(batch: DataFrame, screen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``batch`` with ``hits``: the loads (``load_version`` of ``screen``) that may hold the row's key; empty
    if none can. ``batch`` must be unique by ``keys``.

    Batch keys and bitmaps meet by slot, once for each number of slots in use (a power of two, so
    there are few). What moves is a key's hash and the bitmaps, never a fact.
    """
    hash_ = F.xxhash64(*keys)
    sizes = sorted(r[0] for r in screen.select("slots").distinct().collect())
    if not sizes:
        return batch.withColumn("hits", F.expr("CAST(array() AS array<int>)"))
    asked = batch.select(hash_.alias("h")).distinct()
    asked = asked.select("h", F.explode(F.array(*[F.lit(s).cast("long") for s in sizes])).alias("slots"))
    place = F.pmod(F.col("h"), (F.col("slots") * SLOT_BITS).cast("long"))
    asked = asked.withColumn("slot", F.floor(place / SLOT_BITS).cast("long")).withColumn("at", F.pmod(place, F.lit(SLOT_BITS)))
    found = asked.join(screen, ["slots", "slot"]).where(_bit(F.col("bits"), F.col("at")))
    found = found.groupBy("h").agg(F.array_sort(F.collect_set("load_version")).alias("hits"))
    rows = batch.withColumn("__h", hash_).join(found.withColumnRenamed("h", "__h"), "__h", "left").drop("__h")
    return rows.withColumn("hits", F.coalesce("hits", F.expr("CAST(array() AS array<int>)")))


def screened_new_rows(batch: DataFrame, facts: DataFrame, screen: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[int]]:
    """(rows of ``batch`` whose key is not among ``facts``, loads that were read).

    ``facts`` carry ``load_version``, their partition column; ``batch`` is unique by ``keys`` and should
    be a written table. Loads without a hit are not read; if none is hit, ``facts`` are not in the plan.
    """
    tagged = screened(batch, screen, keys)
    loads = sorted(r[0] for r in tagged.select(F.explode("hits")).distinct().collect())  # one number a load
    rows = tagged.drop("hits")
    if not loads:
        return rows, []
    sure = tagged.where(F.size("hits") == 0).drop("hits")
    maybe = tagged.where(F.size("hits") > 0).drop("hits")
    old = facts.where(F.col("load_version").isin(loads)).select(*keys)
    return sure.unionByName(maybe.join(old, list(keys), "left_anti")), loads
