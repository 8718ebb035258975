"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import cut_lineage, ensure_checkpoint_dir

__all__ = [
    "claim",
    "crc_remainder",
    "cut_lineage",
    "documents",
    "local_path",
    "materialize",
    "shared_dir",
    "slices",
    "table",
    "whole_text",
    "word_codes",
    "word_index",
    "words",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def whole_text(col: str = "text") -> Column:
    """The text; a null counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def crc_remainder(col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(modulus)


def materialize(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write to the shared checkpoint folder and read back (cuts lineage, survives lost executors)."""
    if compression is None:
        return cut_lineage(df, label)
    path = shared_dir(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name (not yet made) below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark, allow_local_fallback=True)
    return f"{root.rstrip('/')}/starloom-{label}-{uuid.uuid4().hex}"


def local_path(uri: str) -> str:
    """The path that Python's file calls take for a ``file:`` URI or plain path.

    Model files that are memory-mapped must lie on a file system every machine mounts.
    """
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped levels need a mounted shared folder, not {uri}")
    return parts.path


def write_file(path: str, data: bytes) -> None:
    """Write whole or not at all: a retried or speculative task replaces the file by the same bytes."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    tmp = f"{path}.{uuid.uuid4().hex}.tmp"
    with open(tmp, "wb") as f:
        f.write(data)
    os.replace(tmp, path)


_OWNER: list[tuple[str, Callable[[], None]]] = []


def claim(owner: str, release: Callable[[], None] = lambda: None) -> None:
    """Worker processes serve many stages: what another operator has kept in this one is let go."""
    if _OWNER and _OWNER[0][0] != owner:
        _OWNER.pop()[1]()
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(AttributeError, OSError):  # glibc: give freed memory back
            ctypes.CDLL(None).malloc_trim(0)
    if not _OWNER:
        _OWNER.append((owner, release))


# Text (or ids) that a task turns into Python objects at a time.
PART_BYTES = 6_000_000


def slices(batch: pa.RecordBatch, column: str, size: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``size`` bytes of ``column``, one row at least."""
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths, dtype=np.int64) // size
    starts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
    for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def words(text: str | None) -> list[bytes]:
    """Lower-case A-Z only, then words ``[^\\x20\\x09-\\x0D]+`` (what ``bytes.split`` splits on)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_codes(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words as binary, the number of each word in turn, words per text) of a column of texts, split
    where :func:`words` splits. No word becomes a Python object."""
    texts = texts.cast(pa.string()).fill_null("")
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    coded = split.flatten().dictionary_encode()
    known = coded.dictionary.cast(pa.binary())
    numbers = coded.indices.to_numpy(zero_copy_only=False)
    offsets = split.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    empty = pc.index(known, pa.scalar(b"", pa.binary())).as_py()
    if empty >= 0:  # before leading and after trailing white space
        kept = numbers != empty
        offsets = np.concatenate([[0], np.cumsum(kept)])[offsets]
        numbers = numbers[kept]
        numbers = numbers - (numbers > empty)
        known = pa.concat_arrays([known.slice(0, empty), known.slice(empty + 1)])
    return known, numbers, np.diff(offsets)


def word_index(texts: pa.Array, lower: bool = False) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """:func:`word_codes` with the distinct words as a list; only these become Python objects."""
    known, numbers, sizes = word_codes(texts, lower)
    if not len(known):
        return [], numbers, sizes
    # Cut from one buffer, several times as fast as to_pylist.
    ends = np.frombuffer(known.buffers()[1], np.int32)[known.offset : known.offset + len(known) + 1]
    raw, at = known.buffers()[2].to_pybytes(), ends.tolist()
    return [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], numbers, sizes
