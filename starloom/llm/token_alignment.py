"""Cross-tokenizer alignment: which ids of tokenizer A and of tokenizer B cover the same bytes.

Both tokenizers read space + text. Byte offsets where tokens of both end cut the text into groups;
inside a group every A and B token whose byte ranges overlap are linked. A pair's count is the number
of documents that hold it linked.

1. Neither tokenizer has a token that goes on from a character into the white space (space, tab, line
   feed) after it, so a text is a row of chunks (white space, then a word) that are encoded and
   aligned each for itself, once a worker and chunk. The constructor checks this of the vocabulary.
2. Identity-map fast path: ``same[a]`` is the B id with the bytes of a. Links (a, same[a]), which is
   what exact one-to-one groups give, are counted in a vector as long as A's vocabulary, one a task.
   Only the other pairs are shuffled, as the distinct pairs of a block of documents.
3. Every block gets back the counts of its own pairs, so nothing that grows with the corpus is
   broadcast. Broadcast or sent to the driver are two vectors as long as A's vocabulary.

Defined results: null and empty texts, and texts whose joined A or B bytes differ from space + text
(those with U+2581), have no tokens: zeros and empty strings. Very long texts are read in segments of
``SEGMENT`` characters, cut between chunks. Repeated rows count as documents of their own. A null
doc_id stays null. Ties for an A id's highest count are all best. An empty table gives no rows. Other
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm.common import claim, materialize, shared_dir, slices

SEGMENT = 1_000_000
# Chunks a worker remembers.
MEMO, MEMO_BYTES = 500_000, 64_000_000
LONGEST_MEMO = 64
# Links expanded at a time.
LINKS = 4_000_000

# Characters that some reader of \s takes for white space, besides the three that start a chunk.
_UNSURE = "\r\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -‏    ⁠　﻿"
_ODD = re.compile(f"[{_UNSURE}]")
_PLAIN = re.compile(r"[ \t\n]*[^ \t\n]+|[ \t\n]+")
_BOUNDARY = re.compile(f"(?<=[^ \\t\\n{_UNSURE}])(?=[ \\t\\n])")


def chunks(text: str) -> list[str]:
    """The text cut wherever white space follows a character that surely is none."""
    if _ODD.search(text):
        return [c for c in _BOUNDARY.split(text) if c]
    return _PLAIN.findall(text)


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """The text in parts of about ``size`` characters, cut between chunks."""
    start = 0
    while len(text) - start > size:
        cut = _BOUNDARY.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def byte_level_alphabet() -> dict[str, int]:
    """The characters by which a byte-level vocabulary writes bytes: printable Latin-1 characters stand
    for themselves, the other bytes in order for U+0100 and on."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))


def _among(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether each of the rising numbers ``x`` is one of the rising numbers ``y`` (same largest)."""
    return y[np.searchsorted(y, x)] == x if len(y) else np.zeros(len(x), bool)


class Aligner:
    """Encodes and aligns chunks. A pair (a, b) is written as the number ``a * n_b_vocab + b``."""

    def __init__(self, path_a: str, path_b: str):
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # strings of special tokens are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_level_alphabet()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.size_a, self.size_b = max(vocab.values()) + 1, self.b.get_piece_size()
        if self.size_a * self.size_b >= 2**32:
            raise ValueError("pairs of ids must fit in 32 bits")
        self.bytes_a = [b""] * self.size_a
        for token, i in vocab.items():
            known = all(c in alphabet for c in token)
            self.bytes_a[i] = bytes(alphabet[c] for c in token) if known else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.size_b)]
        if any(re.search(r"[^ \t\n▁][ \t\n▁]", p) for p in pieces):
            raise ValueError("a piece goes on into white space: chunks cannot be encoded alone")
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        first: dict[bytes, int] = {}
        for whole in (True, False):  # a piece rather than a byte's token
            for i, own in enumerate(self.bytes_b):
                if self.b.is_byte(i) != whole:
                    first.setdefault(own, i)
        self.same = np.array([first.get(own, -1) for own in self.bytes_a], np.int64)
        self.lead = len(self.b.encode("x"))
        self.known_a, self.known_b = pa.array(self.bytes_a, pa.binary()), pa.array(self.bytes_b, pa.binary())
        self.width_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.width_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # Every id with the sign that follows it in the text of the groups, as four runs of one array.
        signs = [(self.size_a, ","), (self.size_a, "|"), (self.size_b, ","), (self.size_b, ";")]
        self.written = pa.array([f"{i}{sign}" for n, sign in signs for i in range(n)])
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.texts = pa.array([], pa.string())  # groups of each chunk, every one with its ; at the end
        self.stats = np.zeros((0, 5), np.int64)  # ids of A, of B, groups, links, whether bytes agree
        self.starts = np.zeros(0, np.int64)
        self.pairs = np.zeros(0, np.int64)

    @staticmethod
    def _same_bytes(ids: list[list[int]], flat: np.ndarray, known: pa.Array, width: np.ndarray, raw: list[bytes]) -> np.ndarray:
        """Whether the ids' bytes are the chunk's, by chunk."""
        joined = known.take(pa.array(flat))
        first = np.frombuffer(joined.buffers()[1], np.int32)[joined.offset]
        sizes = np.diff(np.concatenate([[0], np.cumsum(width[flat])])[np.cumsum([0, *map(len, ids)])])
        if joined.buffers()[2][int(first) : int(first) + int(sizes.sum())] == pa.py_buffer(b"".join(raw)):
            return sizes == np.array([len(r) for r in raw])
        parts = joined.to_pylist()
        ends = np.cumsum([0, *map(len, ids)]).tolist()
        return np.array([b"".join(parts[x:y]) == r for x, y, r in zip(ends[:-1], ends[1:], raw, strict=True)])

    def align(self, a: list[list[int]], b: list[list[int]]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """(text of the groups, number of groups, number of links, all pairs) of chunks whose encodings
        cover the same bytes. All chunks are laid end to end: between two neighbouring ends of tokens
        lies one A and one B token, which is a link, and each link has one such stretch."""
        ids_a, ids_b = _flat(a), _flat(b)
        ends_a, ends_b = np.cumsum(self.width_a[ids_a]), np.cumsum(self.width_b[ids_b])
        closes_a, closes_b = _among(ends_a, ends_b), _among(ends_b, ends_a)
        cuts, ends = ends_a[closes_a], np.sort(np.concatenate([ends_a, ends_b[~closes_b]]), kind="stable")
        pairs = ids_a[np.searchsorted(ends_a, ends)] * self.size_b + ids_b[np.searchsorted(ends_b, ends)]
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        # A token's place among all: the tokens of its own side before it, those of the other side in
        # earlier groups and, for B, in its own.
        at_a = np.arange(len(ids_a)) + np.searchsorted(group_b, group_a, "left")
        at_b = np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, "right")
        signed = np.empty(len(ids_a) + len(ids_b), np.int64)
        signed[at_a] = ids_a + self.size_a * closes_a
        signed[at_b] = 2 * self.size_a + ids_b + self.size_b * closes_b
        n_a, n_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
        offsets = np.concatenate([[0], np.cumsum(n_a + n_b)]).astype(np.int32)
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), self.written.take(pa.array(signed))), "")
        last = np.concatenate([[0], ends_a])[np.cumsum(n_a)]  # the end of every chunk
        per_chunk = lambda x: np.diff(np.searchsorted(x, last, "right"), prepend=0)
        return texts, per_chunk(cuts), per_chunk(ends), pairs

    def learn(self, new: list[str]) -> None:
        """Encode and align chunks not yet known. A chunk begins with white space, so B reads it after
        a letter of its own, whose ids are cut off again."""
        a = [e.ids for e in self.a.encode_batch_fast(new, add_special_tokens=False)]
        b = [x[self.lead :] for x in self.b.encode(["x" + c for c in new], num_threads=1)]
        raw = [c.encode("utf-8", "surrogatepass") for c in new]
        agree = self._same_bytes(a, _flat(a), self.known_a, self.width_a, raw)
        agree &= self._same_bytes(b, _flat(b), self.known_b, self.width_b, raw)
        if not agree.all():
            a, b = ([x if ok else [] for x, ok in zip(y, agree.tolist(), strict=True)] for y in (a, b))
        texts, groups, links, pairs = self.align(a, b)
        self.index.update(zip(new, range(len(self.texts), len(self.texts) + len(new)), strict=True))
        stats = [np.array([len(x) for x in a]), np.array([len(x) for x in b]), groups, links, agree]
        self.starts = np.concatenate([self.starts, len(self.pairs) + np.cumsum(links) - links])
        self.texts = pa.concat_arrays([self.texts, texts])
        self.stats = np.concatenate([self.stats, np.stack(stats, axis=1).astype(np.int64)])
        self.pairs = np.concatenate([self.pairs, pairs])

    def codes(self, lists: list[list[str]]) -> list[np.ndarray]:
        """The number of every chunk; unknown ones are learned first."""
        if len(self.texts) > MEMO or self.pairs.nbytes > MEMO_BYTES:
            self.clear()
        distinct = set().union(*lists)
        if new := [c for c in distinct if c not in self.index]:
            self.learn(new)
        out = [np.fromiter(map(self.index.__getitem__, x), np.int64, len(x)) for x in lists]
        for c in distinct:
            if len(c) > LONGEST_MEMO:  # kept for this call only
                del self.index[c]
        return out

    def links(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place among ``codes``, pair) of every link, some ``LINKS`` at a time."""
        n = self.stats[codes, 3]
        part = np.cumsum(n) // LINKS
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(codes)]
        for x, y in zip(cuts[:-1], cuts[1:], strict=True):
            own = n[x:y]
            at = np.cumsum(own) - own
            flat = np.arange(own.sum()) + np.repeat(self.starts[codes[x:y]] - at, own)
            yield np.repeat(np.arange(x, y), own), self.pairs[flat]


def _merged(doc_pairs: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order with their summed weights."""
    if not doc_pairs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    values, weights = np.concatenate(doc_pairs), np.concatenate(times)
    order = np.argsort(values, kind="stable")
    values, weights = values[order], weights[order]
    first = np.flatnonzero(np.diff(values, prepend=-1))
    return values[first], np.add.reduceat(weights, first) if len(first) else weights


class _Part:
    """The documents of one block: totals, digest of groups, distinct pairs with their occurrences."""

    def __init__(self, own: Aligner, texts: list[str | None], with_groups: bool):
        n = len(texts)
        self.totals = np.zeros((n, 4), np.int64)
        self.agree = np.array([bool(t) for t in texts])
        self.digest = [hashlib.sha256() for _ in texts]
        self.groups: list[list[str]] | None = [[] for _ in texts] if with_groups else None
        self._seen, self._times = [], []
        self._begun = [False] * n
        waiting: list[tuple[int, str]] = []
        size = 0
        for d, t in enumerate(texts):
            for s in segments(" " + t) if t else ():
                waiting.append((d, s))
                size += len(s)
                if size >= SEGMENT:
                    self._add(own, waiting)
                    waiting, size = [], 0
        if waiting:
            self._add(own, waiting)
        values, self.times = _merged(self._seen, self._times)
        docs = values >> 32
        kept = self.agree[docs]
        self.docs, self.pairs, self.times = docs[kept], values[kept] & 0xFFFFFFFF, self.times[kept]
        self.totals[~self.agree] = 0

    def _add(self, own: Aligner, waiting: list[tuple[int, str]]) -> None:
        coded = own.codes([chunks(s) for _, s in waiting])
        flat, sizes = np.concatenate(coded), np.array([len(c) for c in coded])
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        per_segment = np.add.reduceat(own.stats[flat], offsets[:-1])
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), own.texts.take(pa.array(flat)))
        written = pc.binary_join(lists, "")
        for (d, _), n, stats, text in zip(waiting, sizes.tolist(), per_segment, written, strict=True):
            self.totals[d] += stats[:4]
            if stats[4] != n:
                self.agree[d] = False
            if self.agree[d]:
                text = text.as_buffer()
                if self._begun[d]:
                    self.digest[d].update(b";")
                self._begun[d] = True
                self.digest[d].update(memoryview(text)[:-1])
                if self.groups is not None:
                    self.groups[d].append(text.to_pybytes().decode())
        doc = np.repeat(np.array([d for d, _ in waiting], np.int64), sizes)
        for place, pair in own.links(flat):
            seen, times = np.unique((doc[place] << 32) | pair, return_counts=True)
            self._seen.append(seen)
            self._times.append(times)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner a worker process."""
    claim("aligner", _ALIGNERS.clear)
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
# kind 0: a document; 1: the irregular pairs of a block; 2: a task's vector of regular pairs.
ALIGNED_SCHEMA = (
    "kind int, block long, doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", groups_sha256 string, groups string, codes binary, times binary"
)


def _packed(x: np.ndarray) -> bytes:
    """Rising numbers by their differences."""
    return np.diff(x, prepend=0).astype("<u4").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, "<u4"), dtype=np.int64)


def _rows(kind: int, block: list[int], codes: list[bytes], times: list[bytes], **more) -> pa.RecordBatch:
    n = len(codes)
    columns = {
        "kind": pa.array([kind] * n, pa.int32()),
        "block": pa.array(block, pa.int64()),
        "doc_id": more.get("doc_id", pa.nulls(n, pa.int64())),
        **{c: more.get(c, pa.nulls(n, pa.int64())) for c in COUNTS},
        "groups_sha256": more.get("groups_sha256", pa.nulls(n, pa.string())),
        "groups": more.get("groups", pa.nulls(n, pa.string())),
        "codes": pa.array(codes, pa.binary()),
        "times": pa.array(times, pa.binary()),
    }
    return pa.RecordBatch.from_pydict(columns)


def _align(path_a: str, path_b: str, with_groups: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        block = TaskContext.get().partitionId() << 32
        vector = np.zeros(own.size_a, np.int64)
        for b in (p for batch in batches for p in slices(batch, "text")):
            texts = b.column("text").to_pylist()
            part = _Part(own, texts, with_groups)
            a = part.pairs // own.size_b
            regular = own.same[a] == part.pairs % own.size_b
            vector += np.bincount(a[regular], minlength=own.size_a)
            irregular, place, docs = np.unique(part.pairs[~regular], return_inverse=True, return_counts=True)
            # A code is the place among the block's irregular pairs or, beyond them, a regular pair's A id.
            codes = a + len(irregular)
            codes[~regular] = place
            order = np.lexsort((codes, part.docs))
            codes, times = codes[order], part.times[order]
            ends = np.searchsorted(part.docs, np.arange(len(texts) + 1))
            per_doc = [slice(x, y) for x, y in zip(ends[:-1], ends[1:], strict=True)]
            yield _rows(
                0,
                [block] * len(texts),
                [_packed(codes[s]) for s in per_doc],
                [times[s].astype("<u4").tobytes() for s in per_doc],
                doc_id=b.column("doc_id"),
                **{c: pa.array(part.totals[:, i]) for i, c in enumerate(COUNTS)},
                groups_sha256=pa.array([h.hexdigest() if ok else "" for h, ok in zip(part.digest, part.agree, strict=True)]),
                groups=pa.array(["".join(g)[:-1] if ok else "" for g, ok in zip(part.groups, part.agree, strict=True)])
                if part.groups is not None
                else pa.nulls(len(texts), pa.string()),
            )
            if len(irregular):
                yield _rows(1, [block], [_packed(irregular)], [docs.astype("<u4").tobytes()])
            block += 1
        if vector.any():
            seen = np.flatnonzero(vector)
            yield _rows(2, [block], [_packed(seen)], [vector[seen].astype("<u8").tobytes()])

    return run


def _unpack(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, codes, times in zip(*(b.column(c).to_pylist() for c in ("block", "codes", "times")), strict=True):
                pair = _unpacked(codes)
                docs = np.frombuffer(times, kind).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"block": pa.array(np.full(len(pair), block)), "pair": pa.array(pair), "docs": pa.array(docs)})

    return run


RESULT_SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", n_best long, count_sum long, groups_sha256 string, groups string"


def _answer(vector: np.ndarray, best: np.ndarray, size_b: int):
    """Documents of a block meet the counts of the block's pairs."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        pair, docs = (right.column(c).to_numpy().astype(np.int64) for c in ("pair", "docs"))
        order = np.argsort(pair)
        pair, docs = pair[order], docs[order]
        count = np.concatenate([docs, vector])
        is_best = np.concatenate([docs == best[pair // size_b], (vector == best) & (vector > 0)])
        n_best, count_sum = [], []
        for codes, times in zip(left.column("codes").to_pylist(), left.column("times").to_pylist(), strict=True):
            c, t = _unpacked(codes), np.frombuffer(times, "<u4").astype(np.int64)
            n_best.append(int(t[is_best[c]].sum()))
            count_sum.append(int((t * count[c]).sum()))
        kept = left.select(["doc_id", *COUNTS, "groups_sha256", "groups"]).to_pydict()
        columns = {c: pa.array(kept[c], pa.int64()) for c in ("doc_id", *COUNTS)}
        columns |= {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
        return pa.table(columns | {c: pa.array(kept[c], pa.string()) for c in ("groups_sha256", "groups")})

    return run


class Alignment(NamedTuple):
    """``documents``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups (null
    unless asked for). ``pairs``: a, b, docs - every linked pair and the documents that hold it."""

    documents: DataFrame
    pairs: DataFrame


def align(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False) -> Alignment:
    """Align both tokenizers over every text of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    own = Aligner(path_a, path_b)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    path = shared_dir(spark, "aligned")
    texts.mapInArrow(_align(path_a, path_b, with_groups), ALIGNED_SCHEMA).write.option("compression", "zstd").parquet(path)
    aligned = spark.read.schema(ALIGNED_SCHEMA).parquet(path)

    packed = aligned.select("kind", "block", "codes", "times")
    schema = "block long, pair long, docs long"
    regular = packed.where("kind = 2").drop("kind").mapInArrow(_unpack("<u8"), schema).groupBy("pair").agg(F.sum("docs").alias("docs"))
    vector, best = np.zeros(own.size_a, np.int64), np.zeros(own.size_a, np.int64)
    for r in regular.collect():  # at most one row an id of A
        vector[r["pair"]] = r["docs"]
    in_block = packed.where("kind = 1").drop("kind").mapInArrow(_unpack("<u4"), schema)
    counted = materialize(in_block.groupBy("pair").agg(F.sum("docs").alias("docs")), "aligned-pairs")
    a, b = F.expr(f"pair div {own.size_b}"), F.expr(f"pair % {own.size_b}")
    for r in counted.groupBy(a.alias("a")).agg(F.max("docs").alias("best")).collect():  # likewise
        best[r["a"]] = r["best"]
    best = np.maximum(best, vector)

    answers = in_block.select("block", "pair").join(counted, "pair")
    done = (
        aligned.where("kind = 0")
        .drop("kind")
        .groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(_answer(vector, best, own.size_b), RESULT_SCHEMA)
    )
    exact = np.flatnonzero(vector)
    regular_rows = pa.table({"a": pa.array(exact), "b": pa.array(own.same[exact]), "docs": pa.array(vector[exact])})
    pairs = counted.select(a.alias("a"), b.alias("b"), "docs").unionByName(
        spark.createDataFrame(regular_rows) if len(exact) else spark.createDataFrame([], "a long, b long, docs long")
    )
    return Alignment(done, pairs)
