"""Sequence packing by non-negative least squares over the histogram of lengths.

Every document becomes its token ids and an end id. Whole windows are cut off its front; what is left
(shorter than a window) is described by a histogram with at most one bin a length, whatever the size
of the corpus. Shallow combinations of two or three lengths that fill a window exactly are
enumerated, their repeat counts are solved by non-negative least squares against the histogram and
rounded down to what is there. Residual counts are packed greedily (largest first, then the largest
that still fits) where a window closes with at most ``SLACK`` free places; the rest run one after
another and are cut at window borders, and the last remainder is cut at powers of two, which need no
padding.

Only the histogram (bounded by the window) reaches the driver; the plan is a table of rank ranges
per length. A document finds its place by its rank among the documents of its length, so no group of
equal lengths is gathered anywhere.

Defined results: null and empty texts hold the end id alone; very long texts fill as many windows as
they need; repeated rows and rows of equal length (ties, which go by the order they were written in) are
packed each for itself; a null doc_id stays null; an empty table gives no pieces. Columns besides doc_id
and text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import materialize, slices
from starloom.llm.tokenize import EOD, encoder

WINDOW = 4096
SLACK = 8
TRIPLES = 1500
ROUNDS = 6
# Text that a task turns into ids at a time: words of a part are looked up once.
TEXT_BYTES = 8_000_000

PIECES_SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


# -- the plan over the histogram ------------------------------------------------------------------


def best_triples(weight: np.ndarray, window: int, most: int) -> list[tuple[int, ...]]:
    """The triples a <= b <= c with a + b + c = window and the largest summed weight, among lengths
    of positive weight."""
    lengths = np.flatnonzero(weight > 0)
    found: list[tuple[float, int, int, int]] = []
    for a in lengths[lengths <= window // 3].tolist():
        b = lengths[(lengths >= a) & (lengths <= (window - a) // 2)]
        c = window - a - b
        ok = weight[c] > 0
        if not ok.any():
            continue
        b, c = b[ok], c[ok]
        w = weight[a] + weight[b] + weight[c]
        top = np.argsort(-w, kind="stable")[:8]
        found += [(-float(w[i]), a, int(b[i]), int(c[i])) for i in top]
    return [(a, b, c) for _, a, b, c in sorted(found)[:most]]


def nnls(columns: list[tuple[int, ...]], target: np.ndarray, start: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """min ||A x - target||, x >= 0, by cyclic coordinate descent; column j of A counts the lengths
    of combination j. Returns x and what is left of the target."""
    x = start.copy()
    left = target.astype(float).copy()
    cols = [np.unique(c, return_counts=True) for c in columns]
    for (i, m), v in zip(cols, x, strict=True):
        left[i] -= m * v
    square = [float((m * m).sum()) for _, m in cols]
    for _ in range(sweeps):
        moved = 0.0
        for j, (i, m) in enumerate(cols):
            new = max(0.0, x[j] + float((m * left[i]).sum()) / square[j])
            d = new - x[j]
            if d:
                left[i] -= m * d
                x[j] = new
                moved = max(moved, abs(d))
        if moved < 0.25:
            break
    return x, left


def combinations(hist: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths that fill the window, repeat count) from the least squares solution."""
    have = np.flatnonzero(hist)
    columns: list[tuple[int, ...]] = [(int(a), int(window - a)) for a in have if a <= window - a and hist[window - a]]
    x = np.zeros(len(columns))
    left = hist.astype(float)
    if columns:
        x, left = nnls(columns, hist, x)
    known = set(columns)
    for _ in range(ROUNDS):
        fresh = [t for t in best_triples(np.where(hist > 0, np.maximum(left, 0), 0), window, TRIPLES) if t not in known]
        if not fresh:
            break
        known.update(fresh)
        columns += fresh
        x, left = nnls(columns, hist, np.concatenate([x, np.zeros(len(fresh))]), 20)
    free = hist.copy()
    out = []
    for j in np.argsort(-x, kind="stable"):
        i, m = np.unique(columns[j], return_counts=True)
        k = int(min(np.floor(x[j] + 1e-9), (free[i] // m).min()))
        if k > 0:
            free[i] -= m * k
            out.append((columns[j], k))
    return out


def greedy(free: np.ndarray, window: int, slack: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths that fill a window up to ``slack``, largest first; lowers ``free``."""
    out = []
    for largest in range(len(free) - 1, 0, -1):
        while free[largest]:
            own, gap = [largest], window - largest
            taken = {largest: 1}
            at = min(gap, len(free) - 1)
            while gap > slack and at > 0:
                if free[at] > taken.get(at, 0):
                    own.append(at)
                    taken[at] = taken.get(at, 0) + 1
                    gap -= at
                    at = min(at, gap)
                else:
                    at -= 1
            if gap > slack:
                break
            k = int(min(free[i] // m for i, m in taken.items()))
            for i, m in taken.items():
                free[i] -= m * k
            out.append((tuple(own), k))
    return out


@dataclass
class Plan:
    """Where the documents with a remainder of each length go. ``keys`` (length and first rank of a
    range, sorted) select ``sequence`` and ``offset``; ranks from ``cut_from`` on are laid out one
    after another from ``cut_base`` and cut."""

    window: int
    keys: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    cut_from: np.ndarray
    cut_base: np.ndarray
    first_cut: int
    cut_total: int
    sequences: int

    def place(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start within the remainder, length, sequence, offset) of its pieces."""
        if rank < self.cut_from[length]:
            i = int(np.searchsorted(self.keys, (length << 44) + rank, side="right")) - 1
            first = int(self.keys[i]) & ((1 << 44) - 1)
            return [(0, length, int(self.sequence[i]) + rank - first, int(self.offset[i]))]
        at = int(self.cut_base[length]) + (rank - int(self.cut_from[length])) * length
        out, done = [], 0
        while done < length:
            seq, off, room = self.cut(at + done)
            n = min(room, length - done)
            out.append((done, n, seq, off))
            done += n
        return out

    def cut(self, at: int) -> tuple[int, int, int]:
        """(sequence, offset in it, places to its end) of a place in the run of cut documents."""
        whole = self.cut_total // self.window
        if at < whole * self.window:
            return self.first_cut + at // self.window, at % self.window, self.window - at % self.window
        at -= whole * self.window
        rest, seq = self.cut_total - whole * self.window, self.first_cut + whole
        for bit in reversed(range(rest.bit_length())):
            size = 1 << bit
            if rest & size:
                if at < size:
                    return seq, at, size - at
                at -= size
                seq += 1
        raise ValueError("beyond the last place")


def make_plan(hist: np.ndarray, window: int = WINDOW, slack: int = SLACK, first: int = 0) -> Plan:
    """``hist[n]``: documents whose remainder has n ids, 0 < n < window."""
    free = hist.copy()
    patterns = combinations(hist, window)
    for lengths, k in patterns:
        for n in lengths:
            free[n] -= k
    patterns += greedy(free, window, slack)
    used = np.zeros(len(hist), np.int64)
    rows = []
    seq = first
    for lengths, k in patterns:
        offset = 0
        for n in lengths:
            rows.append(((int(n) << 44) + int(used[n]), seq, offset))
            used[n] += k
            offset += n
        seq += k
    rows.sort()
    left = hist - used
    lengths = np.arange(len(hist))
    order = lengths[::-1]
    base = np.zeros(len(hist), np.int64)
    base[order] = np.concatenate([[0], np.cumsum((left * lengths)[order])[:-1]])
    total = int((left * lengths).sum())
    table = np.array(rows, np.int64).reshape(-1, 3)
    extra = total // window + int(total % window).bit_count()
    return Plan(window, table[:, 0], table[:, 1], table[:, 2], used, base, seq, total, seq + extra)


# -- over the corpus ------------------------------------------------------------------------------


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        total = 0
        for batch in batches:
            for b in slices(batch, "text", TEXT_BYTES):
                ids = enc.encode_column(b.column("text"))
                n = pc.divide(pc.binary_length(ids).cast(pa.int64()), 2)
                ends = np.cumsum(n.to_numpy()) + total
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), n, ids, pa.array(ends) if len(ends) else n], ["doc_id", "n", "ids", "end"])
                total = int(ends[-1]) if len(ends) else total

    return run


def tokenise(docs: DataFrame, path: str, label: str = "token-ids") -> DataFrame:
    """(rid, doc_id, n, ids, end) written once. ``rid`` is unique, its high bits name the writing task;
    ``end`` counts the ids of that task up to and with the row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = rows.mapInArrow(_encode(path), "doc_id long, n long, ids binary, end long")
    return materialize(ids.withColumn("rid", F.monotonically_increasing_id()), label, compression="zstd")


def before(rows: DataFrame, value: str, name: str, per: list[str]) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows with a smaller rid and equal ``per``.

    Sums within each writing task, then over the tasks' totals (one row a task and ``per`` value).
    """
    task = F.shiftright("rid", 33).alias("__task")
    own = Window.partitionBy("__task", *per).orderBy("rid").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__task", task).withColumn("__own", F.coalesce(F.sum(value).over(own), F.lit(0)))
    totals = rows.groupBy("__task", *per).agg(F.sum(value).alias("__sum"))
    over = Window.partitionBy(*(per or [F.lit(0)])).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("__task", *per, F.coalesce(F.sum("__sum").over(over), F.lit(0)).alias("__base"))
    return rows.join(totals, ["__task", *per]).withColumn(name, F.col("__own") + F.col("__base")).drop("__task", "__own", "__base")


def _place(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = plan.window
        piece = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "sequence_id", "offset")]))
        for b in batches:
            out = []
            for n, window, rank in zip(*(b.column(c).to_pylist() for c in ("n", "window", "rank")), strict=True):
                full = n // w
                own = [(k * w, w, window + k, 0) for k in range(full)]
                if n % w:
                    own += [(full * w + s, m, q, o) for s, m, q, o in plan.place(n % w, rank)]
                out.append([{"start": s, "length": m, "sequence_id": q, "offset": o} for s, m, q, o in own])
            yield pa.RecordBatch.from_arrays([b.column("rid"), pa.array(out, piece)], ["rid", "pieces"])

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in (part for batch in batches for part in slices(batch, "ids")):
        out: dict[str, list] = {c: [] for c in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")}
        for doc, n, ids, pieces in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n", "ids", "pieces")), strict=True):
            own = np.frombuffer(ids, "<u2").astype("<u4")
            for p in pieces:
                for c in ("start", "length", "sequence_id", "offset"):
                    out[c].append(p[c])
                out["doc_id"].append(doc)
                out["doc_tokens"].append(n)
                out["ids"].append(own[p["start"] : p["start"] + p["length"]].tobytes())
        types = {"ids": pa.binary()}
        yield pa.RecordBatch.from_pydict({c: pa.array(v, types.get(c, pa.int64())) for c, v in out.items()})


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, slack: int = SLACK) -> DataFrame:
    """Pieces of all documents: ``PIECES_SCHEMA``; ids are little-endian unsigned 32-bit."""
    tokens = tokenise(docs, tokenizer)
    rows = tokens.select("rid", "n").withColumn("rest", F.col("n") % window).withColumn("full", F.floor(F.col("n") / window))
    # At most ``window`` rows.
    counts = rows.groupBy("rest").agg(F.count("*").alias("k"), F.sum("full").alias("full")).collect()
    hist = np.zeros(window, np.int64)
    for r in counts:
        hist[r["rest"]] = r["k"] if r["rest"] else 0
    plan = make_plan(hist, window, slack, first=sum(int(r["full"]) for r in counts))
    placed = before(rows.withColumn("one", F.lit(1)), "one", "rank", ["rest"])
    long = before(rows.where("full > 0").select("rid", "full"), "full", "window", [])
    placed = placed.join(long.select("rid", "window"), "rid", "left").select("rid", "n", F.coalesce("window", F.lit(0)).alias("window"), "rank")
    piece = "array<struct<start:bigint,length:bigint,sequence_id:bigint,offset:bigint>>"
    pieces = placed.mapInArrow(_place(plan), f"rid long, pieces {piece}")
    return tokens.join(pieces, "rid").select("doc_id", "n", "ids", "pieces").mapInArrow(_cut, PIECES_SCHEMA)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the pieces of each sequence put together; bounded by the window."""
    own = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(own, F.lit("").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    return pieces.groupBy("sequence_id").agg(joined.alias("ids"))
