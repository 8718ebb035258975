"""Near-duplicates by b-bit MinHash.

1. One pass over the texts: the distinct shingles, a key of the whole set, ``k`` minima. Bands are
   hashed from the full minima; of each minimum only ``BITS`` low bits are kept, packed in longs.
2. Texts with equal sets collapse to one class, so exact copies cost nothing further.
3. Every band bucket pairs its members with ``LEADERS`` of them, never all with all. Candidates whose
   collision-corrected similarity, from bit counts of the packed signatures, is far below the
   threshold are dropped; the rest are confirmed on the full sets.
4. Buckets that still hold more than one component are looked at again: members outside the first
   component against the members of other components, so no link between components is lost to the
   choice of leaders (these may coincide, so a bucket counts from two members besides them on). Each
   member near one of its bucket's leaders carries the few shingles by which
   its set differs from that leader's; two such differences give the exact similarity, so the join
   itself leaves links only and its rows do not grow with the square of a group. Other pairs are
   filtered by the estimate and confirmed.
5. Components by large-star and small-star steps.

A pair at the threshold is missed by all 25 bands of 5 with probability 8e-7 at 0.85 and 5e-5 at
0.8. Defined results: null and empty texts have no shingle, no links and stand alone; very long texts are
read whole; repeated rows fall in one class; a row with a null id is linked through equal sets only and
gets the smallest id it reaches so (null if none); of equal ids or ties the smallest id stands for its
group; an empty table gives no rows. Columns besides doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import materialize, slices
from starloom.llm.components import components
from starloom.llm.shingles import keep_hashes, set_key, shingle_set

BANDS, ROWS, BITS, MINIMA = 25, 5, 4, 128
LONGS = MINIMA * BITS // 64
# Standard deviations of the estimate that a true link may fall below the threshold.
MARGIN = 5.0
# Members of a bucket that every other member is compared with in the first round.
LEADERS = 4
# Estimated similarity to a leader from which a member carries its difference to it.
NEAR_LEADER = 0.5

SIGNATURE_SCHEMA = (
    "doc_id long, n_shingles long, cls binary, bands array<long>, "
    + ", ".join(f"sig{i} long" for i in range(LONGS))
)


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240601)
    a = rng.integers(1, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 2**63, MINIMA, dtype=np.uint64)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash minima, one row per non-empty set."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    a, b = _permutations()
    out = np.empty((len(sets), MINIMA), np.uint64)
    for p in range(MINIMA):
        h = flat * a[p]
        h += b[p]
        h ^= h >> np.uint64(32)
        out[:, p] = np.minimum.reduceat(h, starts)
    return out


def pack(low: np.ndarray) -> np.ndarray:
    """The ``BITS`` low bits of each minimum, packed into ``LONGS`` longs a row."""
    per = 64 // BITS
    nibbles = (low & np.uint64(2**BITS - 1)).reshape(len(low), LONGS, per)
    shifts = np.arange(per, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(nibbles << shifts, axis=2).view(np.int64)


def band_keys(m: np.ndarray) -> np.ndarray:
    rows = m[:, : BANDS * ROWS].reshape(len(m), BANDS, ROWS)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(m), BANDS)).copy()
    for r in range(ROWS):
        h = (h ^ rows[:, :, r]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keep_hashes()
    for batch in batches:
        for part in slices(batch, "text"):
            sets = [shingle_set(t) for t in part.column("text").to_pylist()]
            full = [i for i, s in enumerate(sets) if len(s)]
            bands: list[list[int] | None] = [None] * len(sets)
            sig: list[list[int | None]] = [[None] * len(sets) for _ in range(LONGS)]
            if full:
                m = minima([sets[i] for i in full])
                for i, keys, packed in zip(full, band_keys(m).tolist(), pack(m).tolist(), strict=True):
                    bands[i] = keys
                    for j, x in enumerate(packed):
                        sig[j][i] = x
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    *(pa.array(x, pa.int64()) for x in sig),
                ],
                ["doc_id", "n_shingles", "cls", "bands", *(f"sig{i}" for i in range(LONGS))],
            )


def signatures(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_sign, SIGNATURE_SCHEMA)


def similarity(a: str, b: str) -> Column:
    """Estimated Jaccard of two packed signatures: equal ``BITS``-bit values by bit counts, corrected
    for values that agree by chance (one in ``2**BITS``)."""
    ones = int.from_bytes(b"\x11" * 8, "big")
    differing: Column = F.lit(0)
    for i in range(LONGS):
        x = F.col(f"{a}.sig{i}").bitwiseXOR(F.col(f"{b}.sig{i}"))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        differing = differing + F.bit_count(x.bitwiseAND(F.lit(ones)))
    chance = 1 / 2**BITS
    return (1 - differing / F.lit(float(MINIMA)) - chance) / (1 - chance)


def least_estimate(percent: int) -> float:
    j = percent / 100
    return j - MARGIN * float(np.sqrt(j * (1 - j) / MINIMA)) - 0.02


SETS_SCHEMA = "cls binary, shingles array<long>"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The full set of every class; rows whose text has another set (a repeated id) are left out."""
    keep_hashes()
    for b in (part for batch in batches for part in slices(batch, "text")):
        keys, sets = [], []
        for t, c in zip(b.column("text").to_pylist(), b.column("cls").to_pylist(), strict=True):
            own = shingle_set(t)
            if set_key(own) == c:
                keys.append(c)
                sets.append(own.view(np.int64))
        ends = np.cumsum([0, *(len(x) for x in sets)]).astype(np.int32)
        flat = pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), flat)], ["cls", "shingles"])


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, shingles) of the wanted (cls, label), from one text each."""
    texts = docs.select(F.col("doc_id").cast("long").alias("label"), F.col("text").cast("string").alias("text"))
    rows = texts.join(wanted, "label").select("cls", "text").mapInArrow(_sets, SETS_SCHEMA)
    return rows.groupBy("cls").agg(F.first("shingles").alias("shingles"))


def linked(percent: int) -> Column:
    """Whether the sets ``a`` and ``b`` of a pair reach the threshold; exact."""
    both = F.size(F.array_intersect("a", "b"))
    return 100 * both >= percent * (F.size("a") + F.size("b") - both)


def paired(pairs: DataFrame, classes: DataFrame, value: str) -> DataFrame:
    """(u, v, a, b) and other columns of the pairs: ``value`` of both classes of each pair."""
    own = lambda key, name: classes.select(F.col("cls").alias(key), F.col(value).alias(name))
    return pairs.join(own("u", "a"), "u").join(own("v", "b"), "v")


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per input row."""
    signed = materialize(signatures(docs), "minhash-signatures")
    sig = [f"sig{i}" for i in range(LONGS)]
    classes = materialize(
        signed.where("cls IS NOT NULL")
        .groupBy("cls")
        .agg(F.min("doc_id").alias("label"), F.first("bands").alias("bands"), *(F.first(s).alias(s) for s in sig)),
        "minhash-classes",
    )
    named = classes.where("label IS NOT NULL")  # a class of rows without id has no id to link by
    member = named.select(F.explode("bands").alias("bucket"), "cls")
    picks = [F.min("cls"), *(F.min_by("cls", F.xxhash64(F.lit(salt), "cls")) for salt in range(1, LEADERS))]
    shared = member.groupBy("bucket").agg(F.array_distinct(F.array(*picks)).alias("leaders"), F.count("*").alias("n")).where("n > 1")
    members = materialize(member.join(shared, "bucket").select("bucket", "leaders", "cls"), "minhash-buckets")
    signature = named.select("cls", F.struct(*sig).alias("s"))
    wanted = members.select("cls").distinct()
    sets = materialize(full_sets(docs, named.join(wanted, "cls").select("cls", "label")), "minhash-sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        return paired(pairs, sets, "shingles").where(linked(percent)).select("u", "v")

    led = members.select("cls", F.explode("leaders").alias("leader")).where("cls != leader")
    ends = [F.least("cls", "leader").alias("u"), F.greatest("cls", "leader").alias("v")]
    # Once a pair, with its directions: whether v leads u, and u leads v.
    first = led.groupBy(*ends).agg(F.max(F.col("leader") > F.col("cls")).alias("v_leads"), F.max(F.col("leader") < F.col("cls")).alias("u_leads"))
    estimate = similarity("a", "b").alias("estimate")
    estimates = paired(first, signature, "s").select("u", "v", "v_leads", "u_leads", estimate)
    estimates = estimates.where(F.col("estimate") >= min(NEAR_LEADER, least_estimate(percent)))
    estimates = materialize(estimates, "minhash-estimates")
    candidates = estimates.where(F.col("estimate") >= least_estimate(percent)).select("u", "v")
    links = materialize(confirmed(candidates), "minhash-links")
    part = components(links, "minhash-parts")

    # Buckets of more than one component.
    placed = members.join(part.select(F.col("node").alias("cls"), "root"), "cls", "left").select(
        "bucket", "leaders", "cls", F.coalesce("root", "cls").alias("root")
    )
    split = placed.groupBy("bucket").agg(F.min("root").alias("main"), F.max("root").alias("hi"), F.count("*").alias("n"))
    split = split.where("main != hi").select("bucket", "main", "n")
    # Leaders may coincide: with two or more members besides them, some were never compared.
    rows = placed.join(split, "bucket").where(F.col("n") > F.size("leaders") + 1).drop("n")
    rows = materialize(rows, "minhash-split")

    # A member's reference: the first of its bucket's leaders that it is near to, if any. Members of one
    # reference are compared by what their sets lost and gained against it. A class has at most LEADERS
    # leaders a band, so the array of those near to it is bounded.
    close = estimates.where(F.col("estimate") >= NEAR_LEADER)
    close = close.where("v_leads").select(F.col("u").alias("cls"), F.col("v").alias("leader")).unionByName(
        close.where("u_leads").select(F.col("v").alias("cls"), F.col("u").alias("leader"))
    )
    near = close.groupBy("cls").agg(F.collect_set("leader").alias("near"))
    own = F.filter("leaders", lambda x: (x == F.col("cls")) | F.coalesce(F.array_contains("near", x), F.lit(False)))
    rows = rows.join(near, "cls", "left").withColumn("leader", F.get(own, F.lit(0))).drop("leaders", "near")
    rows = materialize(rows, "minhash-references")
    referred = rows.where("leader IS NOT NULL").select(F.col("cls").alias("u"), F.col("leader").alias("v"), "root").distinct()
    differing = materialize(
        paired(referred, sets, "shingles").select(
            F.col("u").alias("cls"),
            F.col("v").alias("leader"),
            "root",
            F.size("b").alias("size"),
            F.array_except("b", "a").alias("lost"),
            F.array_except("a", "b").alias("new"),
        ),
        "minhash-differences",
    )
    mains = differing.groupBy("leader").agg(F.min("root").alias("main"), F.max("root").alias("hi")).where("main != hi")
    mixed = differing.join(mains.select("leader", "main"), "leader")
    side = lambda c, *own: F.struct("cls", "root", *own).alias(c)
    a = mixed.where("root != main").select(F.col("leader").alias("at"), side("a", "size", "lost", "new"))
    b = mixed.select("leader", "main", side("b", "size", "lost", "new"))
    n_lost, n_new = F.size("a.lost") + F.size("b.lost"), F.size("a.new") + F.size("b.new")
    whole = 2 * F.col("a.size") - n_lost + n_new  # the two set sizes together
    most = F.col("a.size") - F.greatest(F.size("a.lost"), F.size("b.lost")) + F.least(F.size("a.new"), F.size("b.new"))
    both = F.col("a.size") - n_lost + F.size(F.array_intersect("a.lost", "b.lost")) + F.size(F.array_intersect("a.new", "b.new"))
    other_part = (F.col("a.root") != F.col("b.root")) & (
        (F.col("b.root") == F.col("main")) | (F.col("a.cls") < F.col("b.cls"))
    )
    by_difference = a.join(
        b,
        (F.col("at") == F.col("leader"))
        & other_part
        & ((100 + percent) * most >= percent * whole)
        & ((100 + percent) * both >= percent * whole),
    )
    # Pairs without a common reference: by the estimate, to be confirmed.
    rows = materialize(rows.join(signature, "cls"), "minhash-signed")
    a = rows.where("root != main").select(F.col("bucket").alias("at"), side("a", "s.*", "leader"))
    b = rows.select("bucket", "main", side("b", "s.*", "leader"))
    by_estimate = a.join(
        b,
        (F.col("at") == F.col("bucket"))
        & other_part
        & ~F.coalesce(F.col("a.leader") == F.col("b.leader"), F.lit(False))
        & (similarity("a", "b") >= least_estimate(percent)),
    )
    met = [F.least("a.cls", "b.cls").alias("u"), F.greatest("a.cls", "b.cls").alias("v")]
    across = by_difference.select(*met).unionByName(by_estimate.select(*met)).distinct().join(candidates, ["u", "v"], "left_anti")
    more = materialize(confirmed(across), "minhash-across")
    if more.isEmpty():
        joined = part
    else:
        joined = components(part.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more), "minhash-whole")

    rooted = classes.select("cls", "label").join(joined.withColumnRenamed("node", "cls"), "cls", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "cls"))
    least = rooted.groupBy("root").agg(F.min("label").alias("least"))
    ids = rooted.join(least, "root").select("cls", "least")
    return (
        signed.select("doc_id", "n_shingles", "cls")
        .join(ids, "cls", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def deduplicate(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row of each class: the row with the smallest id. A repeated row is kept once; rows with a
    null id, which cannot be told apart by id, are kept once a text."""
    found = near_duplicates(docs, percent)
    ids = materialize(found.where("kept AND doc_id IS NOT NULL").select("doc_id").distinct(), "dedup-kept")
    text = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    named = docs.where("doc_id IS NOT NULL").join(ids, "doc_id", "left_semi").withColumn("__h", text).dropDuplicates(["doc_id", "__h"])
    unnamed = docs.where("doc_id IS NULL").withColumn("__h", text).dropDuplicates(["__h"])
    return named.unionByName(unnamed).drop("__h")
