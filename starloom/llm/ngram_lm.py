"""Language-model scores from an Elias-Fano n-gram trie of order three.

Level 1 holds the words by their 64-bit hashes, in hash-range shards, with their counts. Level 2 holds
the successors of every word, level 3 those of every pair: per shard the contexts (an Elias-Fano
sequence), Elias-Fano pointers into the successors, one Elias-Fano sequence of context-relative
successors (context place * vocabulary + word), a quantised log10 probability for each, and on level 3 a
quantised backoff for each context. A query finds the context's place, then its successor by select over
the high bits (the pointers, which list a context's successors, would cost a score two more selects a
context and find the same); a pair's place is the context of the next level.

Probabilities are smoothed with a Dirichlet prior from order to order:
p(w) = (n(w) + 1) / (N + V + 1), p(w | c) = (n(c, w) + KAPPA p(w | shorter c)) / (n(c) + KAPPA); an
unseen successor has KAPPA / (n(c) + KAPPA) p(w | shorter c), an unseen context the shorter one's
probability. Every text ends with an end token, which is also the context of its first word.

Work over the corpus: a pass each counts words, pairs and triples, one scores; each text block sends
its distinct n-grams once to the shard that owns them, as packed arrays. A context that alone would fill
a good part of a shard is split over all shards by its successors. Shards are files in the shared
folder, written whole or not at all and memory-mapped by the tasks that look things up, so a task pages
in what it asks for, whatever the size of the model. The driver sees counts per shard only.

Defined results: a null or empty text is the end token alone; very long texts and words are read whole;
repeated rows are scored alike and counted as often as they occur; words of equal counts (ties) are equal
to the model; a null id is never held out; an empty training set gives every token 1 / 1; an empty table
gives no rows. Columns besides ``keep``, doc_id and text are ignored, whatever their names. Vocabulary and
pairs together must fit in 64 bits (their numbers' product); two words of one 64-bit hash are one word
(2e-8 likely among a million words), whose counts are added.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from starloom.llm.common import claim, local_path, shared_dir, slices, word_index, write_file
from starloom.llm.elias_fano import EliasFano

# Weight of the shorter context, in counts; near the best for held-out texts of the test documents.
KAPPA = 300.0
# A context with more than this share of a shard's tokens is split by its successors.
HOT_SHARE = 0.25
END = b"\n"  # no word holds white space
# Quantised log10 values: bytes in equal steps from 0 down to -FLOOR.
FLOOR = 12.0
STEP = FLOOR / 255

BLOCK = 16_000_000  # bytes of text that a task holds as tokens at a time


def quantise(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10 / STEP), 0, 255).astype(np.uint8)


def restore(code: np.ndarray) -> np.ndarray:
    return code.astype(np.float64) * -STEP


_hash = xxhash.xxh3_64_intdigest


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


@dataclass
class Block:
    """Texts as local word numbers: ``ids`` of all tokens, an end token after each text."""

    hashes: np.ndarray
    ids: np.ndarray
    ends: np.ndarray  # index behind each text

    @classmethod
    def of(cls, texts: pa.Array) -> Block:
        known, numbers, sizes = word_index(texts, lower=True)
        hashes = np.fromiter(map(_hash, [END, *known]), np.uint64, len(known) + 1)
        ends = np.cumsum(sizes + 1)
        ids = np.zeros(ends[-1], np.int64)  # the end token is number 0
        word = np.ones(len(ids), bool)
        word[ends - 1] = False
        ids[word] = numbers.astype(np.int64) + 1
        return cls(hashes, ids, ends)

    def contexts(self) -> np.ndarray:
        return np.concatenate([[0], self.ids[:-1]])  # the end token, number 0, before each first word


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, Block]]:
    claim("ngrams")
    for b in batches:
        for part in slices(b, column, BLOCK):
            yield part, Block.of(part.column(column))


def _squeeze(values: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return zstandard.compress(planes.tobytes(), 1)


def _unsqueeze(data: bytes, dtype: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(dtype).itemsize, -1).T).reshape(-1).view(dtype)


_PACKED = "shard int, keys binary, counts binary, lower binary"


def _packed(shard: np.ndarray, keys: np.ndarray, counts: np.ndarray, lower: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Rows of (shard, keys, counts, lower); keys ascend within a shard and travel as differences.
    ``lower``: the code of each key's probability under the shorter context."""
    ascending = bool((keys[1:] >= keys[:-1]).all())
    order = np.argsort(shard, kind="stable") if ascending else np.lexsort((keys, shard))
    shard, keys, counts = shard[order], keys[order], counts[order]
    lower = np.zeros(len(keys), np.uint8) if lower is None else lower[order]
    starts = np.flatnonzero(np.diff(shard, prepend=-1))
    out: dict[str, list] = {"shard": [], "keys": [], "counts": [], "lower": []}
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(shard)], strict=True):
        out["shard"].append(int(shard[a]))
        out["keys"].append(_squeeze(np.diff(keys[a:b], prepend=np.uint64(0))))
        out["counts"].append(_squeeze(counts[a:b].astype(np.uint32)))
        out["lower"].append(_squeeze(lower[a:b]))
    if out["shard"]:
        types = {"shard": pa.int32()}
        yield pa.RecordBatch.from_pydict({c: pa.array(v, types.get(c, pa.binary())) for c, v in out.items()})


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per shard its keys, ascending and distinct, with summed counts and their lower codes."""
    rows: dict[int, list[tuple[np.ndarray, ...]]] = {}
    for b in batches:
        for s, k, c, p in zip(*(b.column(x).to_pylist() for x in ("shard", "keys", "counts", "lower")), strict=True):
            own = np.cumsum(_unsqueeze(k, "<u8"), dtype=np.uint64), _unsqueeze(c, "<u4"), _unsqueeze(p, "u1")
            rows.setdefault(s, []).append(own)
    for s in list(rows):
        keys, counts, lower = (np.concatenate(x) for x in zip(*rows.pop(s), strict=True))
        order = np.argsort(keys, kind="stable")
        keys, counts, lower = keys[order], counts[order].astype(np.uint64), lower[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        yield s, keys[first], np.add.reduceat(counts, first), lower[first]


# -- level 1: words -------------------------------------------------------------------------------


def _count_words(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block in blocks(batches):
            counts = np.bincount(block.ids, minlength=len(block.hashes))
            yield from _packed(_shard_of(block.hashes, shards), block.hashes, counts)

    return run


def _write_words(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, hashes, counts, _ in _merged(batches):
            write_file(f"{root}/words-{s}.bin", np.array([len(hashes)], np.uint64).tobytes() + hashes.tobytes() + counts.tobytes())
            # Words that may have to be split later: at most 64 a shard can hold 1/64 of its tokens.
            top = np.flatnonzero(counts >= max(1.0, counts.sum() / 64))[:64]
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([s], pa.int32()),
                    "n": pa.array([len(hashes)], pa.int64()),
                    "tokens": pa.array([int(counts.sum())], pa.int64()),
                    "top": pa.array([top.tolist()], pa.list_(pa.int64())),
                    "top_counts": pa.array([counts[top].astype(np.int64).tolist()], pa.list_(pa.int64())),
                }
            )

    return run


@dataclass
class Shape:
    """What all tasks need to know of a model: sizes, places and the split contexts."""

    root: str
    shards: int
    offsets: np.ndarray  # number of the first word of each shard, then the vocabulary size
    tokens: int
    hot: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))  # words whose successors are split
    pair_offsets: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))  # of level 2's shards
    hot_pairs: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))  # ascending
    hot_counts: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    triples: frozenset[int] = frozenset()  # the shards of level 3 that exist

    @property
    def vocabulary(self) -> int:
        return int(self.offsets[-1])

    def base_log10(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1.0) / (self.tokens + self.vocabulary + 1.0))

    @staticmethod
    def backoff_log10(count: np.ndarray) -> np.ndarray:
        return np.log10(KAPPA / (count + KAPPA))

    def word_shard(self, number: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, number, side="right") - 1

    def pair_shard(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The context's shard, or for a split context ``shards`` + the word's shard."""
        out = self.word_shard(context)
        if len(self.hot):
            split = np.isin(context, self.hot)
            out[split] = self.shards + self.word_shard(word[split])
        return out

    def triple_shard(self, pair: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The pair's shard, or for a split pair 2 * ``shards`` + the word's shard."""
        out = np.searchsorted(self.pair_offsets, pair, side="right") - 1
        if len(self.hot_pairs):
            split = np.isin(pair, self.hot_pairs)
            out[split] = 2 * self.shards + self.word_shard(word[split])
        return out


class Vocabulary:
    """Memory-mapped level 1."""

    def __init__(self, shape: Shape):
        self.shape = shape
        self.maps: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _map(self, s: int) -> tuple[np.ndarray, np.ndarray]:
        if s not in self.maps:
            raw = np.memmap(f"{self.shape.root}/words-{s}.bin", np.uint64, "r").view(np.ndarray)
            n = int(raw[0])
            self.maps[s] = raw[1 : 1 + n], raw[1 + n : 1 + 2 * n]
        return self.maps[s]

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers (-1: unknown) and counts."""
        number, count = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        order = np.argsort(hashes, kind="stable")
        shard = _shard_of(hashes[order], self.shape.shards)
        size = np.diff(self.shape.offsets)
        for s in np.unique(shard).tolist():
            if not size[s]:
                continue
            at = order[shard == s]
            known, counts = self._map(s)
            i = np.minimum(np.searchsorted(known, hashes[at]), len(known) - 1)
            hit = known[i] == hashes[at]
            number[at[hit]] = self.shape.offsets[s] + i[hit]
            count[at[hit]] = counts[i[hit]]
        return number, count

    def counts(self, number: np.ndarray) -> np.ndarray:
        """Counts of known, ascending word numbers."""
        shard = np.searchsorted(self.shape.offsets, number, side="right") - 1
        out = np.empty(len(number), np.int64)
        starts = np.flatnonzero(np.diff(shard, prepend=-1))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(number)], strict=True):
            s = int(shard[a])
            out[a:b] = self._map(s)[1][number[a:b] - self.shape.offsets[s]]
        return out


# -- levels 2 and 3: successors -------------------------------------------------------------------


class Successors:
    """A shard of a level: contexts, pointers into the successors, successors, probability codes, and
    a backoff code for each context."""

    def __init__(self, contexts: EliasFano, pointers: EliasFano, successors: EliasFano, codes: np.ndarray, backoffs: np.ndarray, vocabulary: int):
        self.contexts, self.pointers, self.successors = contexts, pointers, successors
        self.codes, self.backoffs, self.vocabulary = codes, backoffs, vocabulary

    @classmethod
    def build(cls, context: np.ndarray, word: np.ndarray, log10: np.ndarray, backoff: np.ndarray, vocabulary: int, universe: int) -> bytes:
        """Pairs ascend by context (below ``universe``), then word; a backoff for each context."""
        new = np.diff(context, prepend=-1) != 0
        first, place = np.flatnonzero(new), np.cumsum(new) - 1
        n = len(first)
        own = [
            EliasFano.build(context[first], universe),
            EliasFano.build(np.append(first, len(context)), len(context) + 1),
            EliasFano.build(place.astype(np.uint64) * np.uint64(vocabulary) + word.astype(np.uint64), n * vocabulary),
        ]
        parts = [p.astype(np.uint64).tobytes() for e in own for p in e.parts()]
        return b"".join(parts) + quantise(log10).tobytes() + quantise(backoff).tobytes()

    @classmethod
    def open(cls, path: str, vocabulary: int) -> Successors:
        raw = np.memmap(path, np.uint8, "r").view(np.ndarray)
        usable = raw[: len(raw) // 8 * 8].view(np.uint64)
        levels, at = [], 0
        for _ in range(3):
            level, at = EliasFano.read(usable, at)
            levels.append(level)
        codes = 8 * at + levels[2].n
        return cls(*levels, raw[8 * at : codes], raw[codes:], vocabulary)

    def find(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of the successors, places of the contexts), -1 where unseen; word -1 is unknown."""
        new = np.diff(context, prepend=-1) != 0  # queries come sorted: equal contexts stand together
        place = self.contexts.find(context[new])[np.cumsum(new) - 1]
        out = np.full(len(context), -1, np.int64)
        known = np.flatnonzero((place >= 0) & (word >= 0))
        x = place[known].astype(np.uint64) * np.uint64(self.vocabulary) + word[known].astype(np.uint64)
        out[known] = self.successors.find(x)
        return out, place

    def successors_of(self, context: int) -> tuple[np.ndarray, np.ndarray]:
        """The words seen after a context, by the pointers, and their log10 probabilities."""
        place = int(self.contexts.find(np.array([context]))[0])
        if place < 0:
            return np.empty(0, np.int64), np.empty(0)
        a, b = self.pointers.access(np.array([place, place + 1])).astype(np.int64).tolist()
        values = self.successors.access(np.arange(a, b)) - np.uint64(place * self.vocabulary)
        return values.astype(np.int64), restore(self.codes[a:b])


def _count_pairs(shape: Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(shape)
        v = np.uint64(shape.vocabulary)
        for _, block in blocks(batches):
            number, _ = vocabulary.numbers(block.hashes)
            token = number[block.ids].astype(np.uint64)
            context = number[block.contexts()].astype(np.uint64)
            keys, counts = np.unique(context * v + token, return_counts=True)
            shard = shape.pair_shard((keys // v).astype(np.int64), (keys % v).astype(np.int64))
            yield from _packed(shard, keys, counts)

    return run


def _write_pairs(shape: Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(shape)
        v = np.uint64(shape.vocabulary)
        for s, keys, counts, _ in _merged(batches):
            context, word = (keys // v).astype(np.int64), (keys % v).astype(np.int64)
            distinct, back = np.unique(word, return_inverse=True)
            p = 10.0 ** shape.base_log10(vocabulary.counts(distinct))[back]
            total = vocabulary.counts(context)
            log10 = np.log10((counts + KAPPA * p) / (total + KAPPA))
            first = np.flatnonzero(np.diff(context, prepend=-1))
            data = Successors.build(context, word, log10, shape.backoff_log10(total[first]), shape.vocabulary, shape.vocabulary)
            write_file(f"{shape.root}/pairs-{s}.bin", data)
            # Pairs that may have to be split as contexts: at most 64 can hold 1/64 of a mean shard.
            top = np.flatnonzero(counts >= max(2.0, shape.tokens / shape.shards / 64))
            top = top[np.argsort(-counts[top].astype(np.int64), kind="stable")][:128]
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([s], pa.int32()),
                    "n": pa.array([len(keys)], pa.int64()),
                    "top": pa.array([top.tolist()], pa.list_(pa.int64())),
                    "top_counts": pa.array([counts[top].astype(np.int64).tolist()], pa.list_(pa.int64())),
                }
            )

    return run


def _count_triples(shape: Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(shape)
        v = np.uint64(shape.vocabulary)
        for _, block in blocks(batches):
            found = look.pairs_of(block)
            at = np.flatnonzero(found.before >= 0)
            token = found.number[block.ids[at]].astype(np.uint64)
            keys = found.before[at].astype(np.uint64) * v + token
            order = np.argsort(keys)  # any occurrence of a triple will do: all have one log10
            keys = keys[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
            counts, keys = np.diff(np.append(first, len(keys))), keys[first]
            shard = shape.triple_shard((keys // v).astype(np.int64), (keys % v).astype(np.int64))
            yield from _packed(shard, keys, counts, quantise(found.log10[at[order[first]]]))

    return run


def _write_triples(shape: Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = np.uint64(shape.vocabulary)
        for s, keys, counts, lower in _merged(batches):
            context, word = (keys // v).astype(np.int64), (keys % v).astype(np.int64)
            first = np.flatnonzero(np.diff(context, prepend=-1))
            total = np.add.reduceat(counts, first).astype(np.int64)
            if len(shape.hot_pairs):  # a split pair's successors lie in many shards: its own count
                i = np.minimum(np.searchsorted(shape.hot_pairs, context[first]), len(shape.hot_pairs) - 1)
                total = np.where(shape.hot_pairs[i] == context[first], shape.hot_counts[i], total)
            each = np.repeat(total, np.diff(np.append(first, len(context))))
            log10 = np.log10((counts + KAPPA * 10.0 ** restore(lower)) / (each + KAPPA))
            pairs = int(shape.pair_offsets[-1])
            data = Successors.build(context, word, log10, shape.backoff_log10(total), shape.vocabulary, pairs)
            write_file(f"{shape.root}/triples-{s}.bin", data)
            yield pa.RecordBatch.from_pydict({"shard": pa.array([s], pa.int32())})

    return run


def _hot(rows: dict[int, Row], offsets: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and counts, ascending by number, of what the shards report as frequent."""
    own = sorted(
        (int(offsets[s]) + i, n) for s, r in rows.items() for i, n in zip(r["top"], r["top_counts"], strict=True) if n > least
    )
    return np.array([i for i, _ in own], np.int64), np.array([n for _, n in own], np.int64)


def train(docs: DataFrame, usable: Column, root: str | None = None, shards: int | None = None) -> Shape:
    """Learn from the rows that ``usable`` admits."""
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    root = local_path(root or shared_dir(spark, "ngram-trie"))
    texts = docs.where(usable).select(F.col("text").cast("string").alias("text"))
    top = "top array<long>, top_counts array<long>"

    def level(count, write, parts: int, schema: str) -> dict[int, Row]:
        sent = texts.mapInArrow(count, _PACKED).repartitionById(parts, "shard")
        return {r["shard"]: r for r in sent.mapInArrow(write, schema).collect()}  # a row a shard

    places = lambda rows, n: np.concatenate([[0], np.cumsum([rows[s]["n"] if s in rows else 0 for s in range(n)])]).astype(np.int64)
    one = level(_count_words(shards), _write_words(root), shards, f"shard int, n long, tokens long, {top}")
    shape = Shape(root, shards, places(one, shards), sum(r["tokens"] for r in one.values()))
    shape.hot, _ = _hot(one, shape.offsets, HOT_SHARE * shape.tokens / shards)
    two = level(_count_pairs(shape), _write_pairs(shape), 2 * shards, f"shard int, n long, {top}")
    shape.pair_offsets = places(two, 2 * shards)
    if shape.vocabulary * int(shape.pair_offsets[-1]) >= 2**64:
        raise ValueError("the vocabulary and its pairs exceed 64 bits")
    shape.hot_pairs, shape.hot_counts = _hot(two, shape.pair_offsets, HOT_SHARE * shape.tokens / shards)
    three = level(_count_triples(shape), _write_triples(shape), 3 * shards, "shard int")
    shape.triples = frozenset(three)
    return shape


# -- looking up -----------------------------------------------------------------------------------


@dataclass
class Found:
    """Of a block: word numbers, counts and log10 of its distinct words; of each token the log10 of
    its probability after one word, the pair it ends and the pair before it (-1: none or unseen)."""

    number: np.ndarray
    count: np.ndarray
    base: np.ndarray
    log10: np.ndarray
    pair: np.ndarray
    before: np.ndarray


class Lookup:
    def __init__(self, shape: Shape):
        self.shape = shape
        self.vocabulary = Vocabulary(shape)
        self.maps: dict[str, Successors] = {}

    def _map(self, name: str) -> Successors:
        if name not in self.maps:
            self.maps[name] = Successors.open(f"{self.shape.root}/{name}.bin", self.shape.vocabulary)
        return self.maps[name]

    def _by_shard(self, shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(shard, kind="stable")
        starts = np.flatnonzero(np.diff(shard[order], prepend=-1))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(order)], strict=True):
            yield int(shard[order[a]]), order[a:b]

    def pairs(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, log10 p(word | context)) of pairs of known words; (-1, nan) where unseen."""
        number, log10 = np.full(len(context), -1, np.int64), np.full(len(context), np.nan)
        for s, at in self._by_shard(self.shape.pair_shard(context, word)):
            if self.shape.pair_offsets[s] < self.shape.pair_offsets[s + 1]:
                level = self._map(f"pairs-{s}")
                i, _ = level.find(context[at], word[at])
                hit = i >= 0
                number[at[hit]] = self.shape.pair_offsets[s] + i[hit]
                log10[at[hit]] = restore(level.codes[i[hit]])
        return number, log10

    def triples(self, pair: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 p(word | pair) or nan, log10 backoff of the pair) for known pairs; word -1: unknown."""
        log10, backoff = np.full(len(pair), np.nan), np.zeros(len(pair))
        for s, at in self._by_shard(self.shape.triple_shard(pair, np.maximum(word, 0))):
            if s in self.shape.triples:
                level = self._map(f"triples-{s}")
                i, place = level.find(pair[at], word[at])
                hit, seen = i >= 0, place >= 0
                log10[at[hit]] = restore(level.codes[i[hit]])
                backoff[at[seen]] = restore(level.backoffs[place[seen]])
        if len(self.shape.hot_pairs):  # a word's shard may not hold the split pair at all
            i = np.minimum(np.searchsorted(self.shape.hot_pairs, pair), len(self.shape.hot_pairs) - 1)
            own = restore(quantise(self.shape.backoff_log10(self.shape.hot_counts[i])))
            backoff = np.where(self.shape.hot_pairs[i] == pair, own, backoff)
        return log10, backoff

    def pairs_of(self, block: Block) -> Found:
        number, count = self.vocabulary.numbers(block.hashes)
        base = self.shape.base_log10(count)
        one, back = restore(quantise(base)), restore(quantise(self.shape.backoff_log10(count)))
        ids, context = block.ids, block.contexts()
        log10 = back[context] + one[ids]
        pair = np.full(len(ids), -1, np.int64)
        if self.shape.vocabulary:
            v = np.uint64(self.shape.vocabulary)
            known = np.flatnonzero((number[ids] >= 0) & (number[context] >= 0))
            keys = number[context[known]].astype(np.uint64) * v + number[ids[known]].astype(np.uint64)
            keys, where = np.unique(keys, return_inverse=True)
            found, p = self.pairs((keys // v).astype(np.int64), (keys % v).astype(np.int64))
            pair[known] = found[where]
            p = p[where]
            hit = ~np.isnan(p)
            log10[known[hit]] = p[hit]
        before = np.concatenate([[-1], pair[:-1]])
        before[block.ends[:-1]] = -1  # a text's first word has no pair before it
        return Found(number, count, base, log10, pair, before)

    def score(self, block: Block) -> dict[str, np.ndarray]:
        """Per text: n_tokens, n_known, base_score, score."""
        found = self.pairs_of(block)
        ids, score = block.ids, found.log10
        at = np.flatnonzero(found.before >= 0)
        if len(at):
            w = np.uint64(self.shape.vocabulary + 1)
            keys = found.before[at].astype(np.uint64) * w + (found.number[ids[at]] + 1).astype(np.uint64)
            keys, where = np.unique(keys, return_inverse=True)
            log10, backoff = self.triples((keys // w).astype(np.int64), (keys % w).astype(np.int64) - 1)
            score = score.copy()
            score[at] = np.where(np.isnan(log10[where]), score[at] + backoff[where], log10[where])
        starts = np.concatenate([[0], block.ends[:-1]])
        total = lambda x: np.add.reduceat(x, starts)
        return {
            "n_tokens": np.diff(block.ends, prepend=0),
            "n_known": total((found.count[ids] > 0).astype(np.int64)),
            "base_score": total(found.base[ids]),
            "score": total(score),
        }


def _score(shape: Shape, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(shape)
        for b, block in blocks(batches, "__text"):
            got = look.score(block)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), *(pa.array(x) for x in got.values())], [*keep, *got])

    return run


def score(docs: DataFrame, shape: Shape, keep: list[str]) -> DataFrame:
    """``keep`` columns, n_tokens, n_known, base_score, score (log10); a map, no shuffle."""
    rows = docs.select(*keep, F.col("text").cast("string").alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text")
    return rows.mapInArrow(_score(shape, keep), f"{fields}, n_tokens long, n_known long, base_score double, score double")
