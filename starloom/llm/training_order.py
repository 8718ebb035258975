"""Training-order materialisation: a keyed Feistel permutation deals every sequence a global slot.

The documents' ids, one document after another, are cut into sequences of ``STRIDE`` ids; only the
last may be shorter. Sequence i of N goes to slot ``permute(i)``: a balanced Feistel network over the
smallest even number of bits that holds N, walked along its cycle until the image is below N, so the
slots are a permutation of 0..N-1 without a table or a sort of the corpus. Range partitions of slots
write shards of ``SHARD`` fixed-stride records; slot s lies in shard ``s // SHARD`` at byte
``(s % SHARD) * STRIDE * 2``, so a reader goes through the training order sequentially and resumes
anywhere by arithmetic alone.

Ids are moved once, to the task that writes their shard: a row's place in the corpus is its place in
its task (counted while its ids are made) plus the ids of earlier tasks (one number a task). What one
batch sends to one shard is one compressed block.

The shards are written once, the index of pieces with them, and ``manifest.json`` last: a folder without
it is not complete and :class:`ShardReader` refuses it.

Defined results: null and empty texts give the end id alone; repeated rows and ties are laid out each
for itself; a null doc_id stays null; a very long text runs over as many sequences as it needs; an empty
table gives no slot and no shard. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import local_path, shared_dir, slices, write_file
from starloom.llm.packing import tokenise

STRIDE = 1024  # ids of 16 bits a record
SHARD = 4096
FEISTEL_ROUNDS = 6


def round_keys(key: str) -> list[int]:
    return [int.from_bytes(hashlib.sha256(f"{key}:{r}".encode()).digest()[:8], "little") for r in range(FEISTEL_ROUNDS)]


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _half(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _feistel(x: np.ndarray, half: int, keys: list[int]) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask
    for k in keys:
        left, right = right, left ^ (_mix(right, k) & mask)
    return (left << np.uint64(half)) | right


def _unfeistel(x: np.ndarray, half: int, keys: list[int]) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask
    for k in reversed(keys):
        left, right = right ^ (_mix(left, k) & mask), left
    return (left << np.uint64(half)) | right


def _walk(index: np.ndarray, n: int, step) -> np.ndarray:
    x = step(np.asarray(index).astype(np.uint64))
    while (out := x >= np.uint64(n)).any():  # the domain is under four times n
        x[out] = step(x[out])
    return x.astype(np.int64)


def permute(index: np.ndarray, n: int, key: str) -> np.ndarray:
    """The slots of the given records among n."""
    keys, half = round_keys(key), _half(n)
    return _walk(index, n, lambda x: _feistel(x, half, keys))


def unpermute(slot: np.ndarray, n: int, key: str) -> np.ndarray:
    """The records at the given slots: the inverse of ``permute``."""
    keys, half = round_keys(key), _half(n)
    return _walk(slot, n, lambda x: _unfeistel(x, half, keys))


META = ("slot", "offset", "doc_id", "known", "start", "length")


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places starts[i], starts[i] + 1, ... of all runs, one run after another."""
    return np.arange(lengths.sum()) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def _blocks(n: int, key: str, stride: int, shard: int):
    """Rows (doc_id, first, ids) to one row (shard, n, block) a part and shard: the pieces' ``META`` as
    64-bit numbers, column by column, then their ids, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for b in (part for batch in batches for part in slices(batch, "ids")):
            column = b.column("ids")
            ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) // 2
            ids, size = np.frombuffer(column.buffers()[2] or b"", "<u2"), np.diff(ends)
            first = b.column("first").to_numpy()
            doc = b.column("doc_id")
            known, doc = doc.is_valid().to_numpy(zero_copy_only=False), doc.fill_null(0).to_numpy()
            count = np.where(size > 0, (first + size - 1) // stride - first // stride + 1, 0)
            own = np.repeat(np.arange(len(count)), count)
            if not len(own):
                continue
            seq = _spread(first // stride, count)
            begin = np.maximum(seq * stride, first[own])
            length = np.minimum((seq + 1) * stride, (first + size)[own]) - begin
            start = begin - first[own]
            slot = permute(seq, n, key)
            order = np.argsort(slot // shard, kind="stable")
            meta = np.stack([x[order].astype(np.int64) for x in (slot, begin % stride, doc[own], known[own], start, length)])
            flat = ids[_spread((ends[own] + start)[order], length[order])]
            shards, at = np.unique(slot[order] // shard, return_index=True)
            at = [*at.tolist(), len(order)]
            edge = np.concatenate([[0], np.cumsum(length[order])])[at].tolist()
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array(shards),
                    "n": pa.array(np.diff(at)),
                    "block": pa.array(
                        [pack.compress(meta[:, x:y].tobytes() + flat[i:j].tobytes()) for x, y, i, j in zip(at[:-1], at[1:], edge[:-1], edge[1:], strict=True)],
                        pa.binary(),
                    ),
                }
            )

    return run


def _write_shards(root: str, n: int, stride: int, shard: int):
    """Blocks come sorted by shard and a task holds whole shards; a shard at a time is in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, records, pieces = -1, None, []

        def close() -> pa.RecordBatch:
            size = min(shard, n - current * shard)
            write_file(f"{root}/shard-{current:08d}.bin", records[: size * stride].tobytes())
            own = dict(zip(META, np.concatenate(pieces, axis=1), strict=True))
            own["doc_id"] = pa.array(own["doc_id"], mask=own.pop("known") == 0)
            return pa.RecordBatch.from_pydict({c: pa.array(x) for c, x in own.items()} | {"shard": pa.array(np.full(len(own["slot"]), current))})

        for b in batches:
            for at, count, block in zip(*(b.column(c).to_pylist() for c in ("shard", "n", "block")), strict=True):
                if at != current:
                    if pieces:
                        yield close()
                    current, records, pieces = at, np.zeros(shard * stride, "<u2"), []
                raw = zstandard.decompress(block)
                meta = np.frombuffer(raw, np.int64, len(META) * count).reshape(len(META), count)
                slot, offset, length = meta[0], meta[1], meta[5]
                records[_spread(slot % shard * stride + offset, length)] = np.frombuffer(raw, "<u2", offset=8 * meta.size)
                pieces.append(meta)
        if pieces:
            yield close()

    return run


# Shards that one task writes, one after another.
SHARDS_A_TASK = 4
INDEX_SCHEMA = "slot long, offset long, doc_id long, start long, length long, shard long"


def materialise(
    docs: DataFrame, tokenizer: str, key: str, root: str | None = None, stride: int = STRIDE, shard: int = SHARD
) -> tuple[DataFrame, str, int]:
    """Write the shards, their index and the manifest below ``root``; returns (the index: slot, offset,
    doc_id, start, length, shard), the folder and the number of ids."""
    spark = docs.sparkSession
    root = root or shared_dir(spark, "training-order")
    folder = local_path(root)
    tokens = tokenise(docs, tokenizer).withColumn("task", F.shiftright("rid", 33))
    # One row a writing task.
    sizes = sorted((r["task"], r["n"]) for r in tokens.groupBy("task").agg(F.sum("n").alias("n")).collect())
    total = sum(n for _, n in sizes)
    n = -(-total // stride)
    bases = np.cumsum([0] + [x for _, x in sizes])[:-1]
    table = pa.table({"task": pa.array([t for t, _ in sizes], pa.int64()), "base": pa.array(bases.astype(np.int64))})
    placed = tokens.join(F.broadcast(spark.createDataFrame(table)), "task")
    blocks = placed.select("doc_id", (F.col("base") + F.col("end") - F.col("n")).alias("first"), "ids").mapInArrow(
        _blocks(n, key, stride, shard), "shard long, n long, block binary"
    )
    # Ranges of slots by arithmetic, no sampling; a shard's size is fixed, whatever the data.
    parts = max(1, -(-n // (shard * SHARDS_A_TASK)))
    ranged = blocks.repartitionById(parts, F.expr(f"CAST(shard div {SHARDS_A_TASK} AS INT)")).sortWithinPartitions("shard")
    ranged.mapInArrow(_write_shards(folder, n, stride, shard), INDEX_SCHEMA).write.parquet(f"{root}/index")
    # The one sequence that may be short, and its slot.
    last = int(permute(np.array([n - 1]), n, key)[0]) if n else -1
    manifest = {"total": total, "records": n, "stride": stride, "shard": shard, "last_slot": last, "tokenizer": os.path.basename(tokenizer)}
    write_file(f"{folder}/{MANIFEST}", json.dumps(manifest).encode())
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{root}/index"), root, total


MANIFEST = "manifest.json"


class ShardReader:
    """Sequences in training order from any slot on, by memory-mapped files. The folder says all there
    is to know; ``FileNotFoundError`` if it was not written to its end."""

    def __init__(self, root: str):
        self.root = local_path(root)
        path = f"{self.root}/{MANIFEST}"
        if not os.path.exists(path):
            raise FileNotFoundError(f"{root} holds no complete training order")
        with open(path, "rb") as f:
            own = json.load(f)
        self.total, self.records, self.stride, self.shard, self.last = (own[c] for c in ("total", "records", "stride", "shard", "last_slot"))

    def read(self, slot: int = 0) -> Iterator[tuple[int, np.ndarray]]:
        """(slot, ids) from ``slot`` to the end."""
        while slot < self.records:
            path = f"{self.root}/shard-{slot // self.shard:08d}.bin"
            block = np.memmap(path, "<u2", "r").reshape(-1, self.stride)
            for row in block[slot % self.shard :]:
                size = self.total - (self.records - 1) * self.stride if slot == self.last else self.stride
                yield slot, np.array(row[:size])
                slot += 1
