"""Approximate nearest neighbours by multi-index hashing over learned binary codes.

Vectors are scaled to length one, centred, and turned into ``BITS`` signs by learned orthogonal
rotations (iterative quantisation on a bounded sample of ``SAMPLE`` rows: alternate signs and the
orthogonal Procrustes rotation). A code is cut into ``SUBSTRINGS`` parts, each the key of an index.
Two codes within Hamming radius r agree in some part up to r // SUBSTRINGS bits (pigeonhole), so
probing all keys within that distance retrieves every code within r; these are ranked by the exact
cosine in double precision. The radius is learned too: the ``REACH`` quantile of the distance
between a sampled row's code and those of its true nearest neighbours in the sample, which are no
nearer than its neighbours among all rows. A query with fewer than k rows within the radius widens it.

Equal vectors collapse first: a class keeps its k + 1 smallest ids, so a vector that a third of all
rows share is one entry. Queries meet the index in blocks: every block of rows is indexed in one task
for one block of queries, which returns its k best a query; blocks are bounded by ``BLOCK`` rows and
``QUERIES`` queries, whatever the data.

Defined results: vectors that are null, zero, of another length than the most common one, or hold a
null or non-finite component take no part, as query or candidate; fewer than k other rows: all of
them; rows of equal id and vector are one row, and the query's own id is no candidate; ties of the
cosine go to the smaller id; a null id takes no part; an empty table gives no rows. Columns besides vec_id
and the vector are ignored, whatever their names; vectors of any length are compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import materialize

BITS = 128
SUBSTRINGS = 16
SAMPLE = 6000
REACH = 0.985
ITERATIONS = 20
BLOCK = 8192
QUERIES = 4096


@dataclass
class Coder:
    mean: np.ndarray
    rotations: list[np.ndarray]
    radius: int

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """Packed codes of unit vectors, one row each of BITS / 8 bytes."""
        x = unit - self.mean
        signs = np.concatenate([x @ r > 0 for r in self.rotations], axis=1)[:, :BITS]
        return np.packbits(signs, axis=1, bitorder="little")


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def rotation(x: np.ndarray, seed: int) -> np.ndarray:
    """Iterative quantisation: the rotation whose signs lie nearest to the rotated data."""
    d = x.shape[1]
    r = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0]
    for _ in range(ITERATIONS):
        signs = np.sign(x @ r)
        u, _, v = np.linalg.svd(x.T @ signs)
        r = u @ v
    return r


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between each row of a and each of b (packed)."""
    x, y = a.view(np.uint64), b.view(np.uint64)
    out = np.zeros((len(x), len(y)), np.int16)
    for j in range(x.shape[1]):
        out += np.bitwise_count(x[:, j, None] ^ y[None, :, j])
    return out


def learn(sample: np.ndarray, k: int) -> Coder:
    x = unit(sample.astype(np.float64))
    mean = x.mean(axis=0)
    rotations = [rotation(x - mean, s) for s in range(-(-BITS // x.shape[1]))]
    coder = Coder(mean, rotations, BITS)
    codes = coder.codes(x)
    asked = np.arange(0, len(x), max(1, len(x) // 300))
    cosine = x[asked] @ x.T
    cosine[np.arange(len(asked)), asked] = -2
    nearest = np.argsort(-cosine, axis=1)[:, :k]
    apart = np.take_along_axis(hamming(codes[asked], codes), nearest, axis=1)
    coder.radius = int(np.quantile(apart, REACH))
    return coder


class Index:
    """The rows of one block under each part of their codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes.view(np.uint64)
        parts = codes.view(np.uint8 if BITS // SUBSTRINGS == 8 else np.uint16)
        self.orders, self.starts = [], []
        for p in range(SUBSTRINGS):
            self.orders.append(np.argsort(parts[:, p], kind="stable").astype(np.int32))
            self.starts.append(np.concatenate([[0], np.cumsum(np.bincount(parts[:, p], minlength=2 ** (BITS // SUBSTRINGS)))]))

    @staticmethod
    def probes(radius: int) -> np.ndarray:
        """All differences of a part within the radius."""
        width = BITS // SUBSTRINGS
        return np.array([sum(1 << i for i in c) for r in range(min(radius, width) + 1) for c in combinations(range(width), r)])

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """The rows within the Hamming radius of a packed code: all of them, by the pigeonhole.

        With radius = m q + a, parts 0..a are probed within q and the others within q - 1.
        """
        parts = code.view(np.uint8 if BITS // SUBSTRINGS == 8 else np.uint16)
        q, a = divmod(radius, SUBSTRINGS)
        found = np.zeros(len(self.codes), bool)
        wide, narrow = self.probes(q), self.probes(q - 1) if q else np.empty(0, np.int64)
        for p in range(SUBSTRINGS):
            keys = int(parts[p]) ^ (wide if p <= a else narrow)
            starts = self.starts[p]
            for lo, hi in zip(starts[keys].tolist(), starts[keys + 1].tolist(), strict=True):
                if hi > lo:
                    found[self.orders[p][lo:hi]] = True
        rows = np.flatnonzero(found)
        apart = np.bitwise_count(self.codes[rows] ^ code.view(np.uint64)).sum(axis=1)
        return rows[apart <= radius]


def _search(coder: Coder, k: int):
    def run(key, tables):
        index, queries = (t.to_batches() for t in tables)
        width = len(coder.mean)
        flat = lambda t: [b.column("v").flatten().to_numpy(zero_copy_only=False) for b in t]
        matrix = lambda t: np.concatenate([np.empty(0), *flat(t)]).reshape(-1, width)
        column = lambda t, c: [x for b in t for x in b.column(c).to_pylist()]
        rows, asked = matrix(index), matrix(queries)
        out: tuple[list, list, list, list] = ([], [], [], [])
        if len(rows) and len(asked):
            ids, own = column(index, "ids"), column(queries, "query_id")
            norms, index_of = np.linalg.norm(rows, axis=1), Index(coder.codes(unit(rows)))
            codes = coder.codes(unit(asked))
            for i, query in enumerate(own):
                radius = coder.radius
                near = index_of.within(codes[i], radius)
                while len(near) < min(k + 1, len(rows)):  # too few: every row is within BITS
                    radius = min(BITS, radius + SUBSTRINGS)
                    near = index_of.within(codes[i], radius)
                cosine = (rows[near] @ asked[i]) / (norms[near] * np.linalg.norm(asked[i]))
                order = np.lexsort((np.array([ids[j][0] for j in near]), -cosine))[: k + 1]
                best = sorted(((-cosine[o], v) for o in order for v in ids[near[o]] if v != query))[:k]
                # Equal scores at the edge may hide smaller ids: take all classes that tie with it.
                if len(order) == k + 1:
                    edge = cosine[order[-1]]
                    tied = np.flatnonzero(cosine >= edge)
                    if len(tied) > k + 1:
                        best = sorted(((-cosine[o], v) for o in tied for v in ids[near[o]] if v != query))[:k]
                for score, v in best:
                    out[0].append(query)
                    out[1].append(v)
                    out[2].append(-float(score))
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    return run


def nearest(vectors: DataFrame, is_query, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows that ``is_query`` (a condition on vec_id) admits."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    rows = materialize(rows, "vectors")
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("v") == sizes[0]["d"])

    # A class keeps its k + 1 smallest ids: one may be the query's own. Spark applies the limit within
    # each task before the shuffle, so a hot vector sends k + 1 rows a task.
    by_id = Window.partitionBy("v").orderBy("vec_id")
    few = rows.withColumn("place", F.dense_rank().over(by_id)).where(F.col("place") <= k + 1)
    classes = few.groupBy("v").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
    classes = materialize(classes.withColumn("first", F.col("ids")[0]), "vector-classes")

    sample = classes.orderBy(F.xxhash64("first"), "first").limit(SAMPLE).select("v").collect()
    coder = learn(np.array([r["v"] for r in sample]), k)
    queries = rows.where(is_query(F.col("vec_id"))).select(F.col("vec_id").alias("query_id"), "v").distinct()
    n_index = max(1, -(-classes.count() // BLOCK))
    n_query = max(1, -(-queries.count() // QUERIES))
    spread = lambda n, *by: F.pmod(F.xxhash64(*by), F.lit(n)).cast("int")
    to_all = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    a = classes.select("v", "ids", spread(n_index, "v").alias("ib"), to_all(n_query, "qb"))
    b = queries.select("v", "query_id", spread(n_query, "query_id").alias("qb"), to_all(n_index, "ib"))
    found = a.groupBy("ib", "qb").cogroup(b.groupBy("ib", "qb")).applyInArrow(
        lambda key, x, y: _search(coder, k)(key, (x, y)), "query_id long, vec_id long, score double"
    )
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("neg"), "vec_id"))), 1, k)
    # At most k rows a query and block of rows meet here.
    top = found.groupBy("query_id").agg(best.alias("best")).select("query_id", F.posexplode("best").alias("pos", "b"))
    return top.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.neg")).alias("score"))
