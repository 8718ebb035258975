"""Language identification by a linear-chain conditional random field over words.

Every word of a text gets a label; emissions are sums of learned weights of its character n-grams
(one to four letters, with marks at its ends, so affixes are features of their own) and, for words of
the learned lexicon, of the word itself; transitions between neighbouring words are learned too.
Forward-backward gives every word's label probabilities, so code-switched texts are read word by
word; a document's language is the one with the largest share of letters.

Training: at most ``SAMPLE`` documents a language and ``TOTAL`` in all (the smallest by a hash of the
id), ``WINDOWS`` windows of ``WINDOW`` words each; a token of more than ``LONGEST`` letters, as in scripts
without spaces, is learned in pieces. Windows of different languages are strung together, so the
model sees switches. The bounds keep the sample and the fit small on the driver; prediction reads whole
texts of all rows.

Defined results: null texts and texts without a letter are ``und`` with score 0; very long texts and
words are read whole; repeated rows get equal predictions; of languages with equal shares the first by
name is taken; without a usable training row everything is ``und``; an empty table gives no rows. Columns
besides ``keep``, doc_id, text and lang are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import claim, slices, word_index

SAMPLE, TOTAL = 800, 6400
WINDOWS, WINDOW = 3, 20
LEXICON_COUNT = 4
BUCKETS = 1 << 17
ORDERS = (1, 2, 3, 4)
STEPS = 120
UNDETERMINED = "und"
# Words that one vectorised forward-backward run holds.
GROUP = 250_000
LONGEST = 40

_OUTER = ".,;:!?\"'()[]{}<>*#$%&@|+~`-_=/\\"


def clean_word(token: str) -> str:
    """The token in lower case without outer signs; empty if it holds no letter."""
    w = token.lower().strip(_OUTER)
    return w if w.isalpha() or any(c.isalpha() for c in w) else ""


def text_words(text: str | None) -> list[str]:
    """Lower-case words that hold a letter, without outer signs."""
    return [w for w in (clean_word(t) for t in re.split(r"[\x20\x09-\x0D]+", text or "")) if w]


def word_features(words: list[str], lexicon: set[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all words, one after another, and where each word's begin. Words longer
    than ``LONGEST`` letters are described by all their n-grams like any other."""
    joined = "".join(f"\x02{w}\x03" for w in words)
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    left = np.repeat(starts + sizes, sizes) - np.arange(len(chars))  # letters to the word's end
    per_order, owner = [], []
    own = np.repeat(np.arange(len(words)), sizes)
    h = np.zeros(len(chars), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        shifted = np.zeros(len(chars), np.uint64)
        shifted[: len(chars) - n + 1] = chars[n - 1 :]
        h = (h ^ shifted) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
        h ^= h >> np.uint64(29)
        if n in ORDERS:
            valid = left >= n
            per_order.append((h[valid] >> np.uint64(11)) % np.uint64(BUCKETS))
            owner.append(own[valid])
    known = [(i, w) for i, w in enumerate(words) if w in lexicon]
    if known:
        ids = np.array([hash_word(w) for _, w in known], np.uint64)
        per_order.append(ids % np.uint64(BUCKETS))
        owner.append(np.array([i for i, _ in known]))
    features, owners = np.concatenate(per_order).astype(np.int64), np.concatenate(owner)
    order = np.argsort(owners, kind="stable")
    return features[order], np.searchsorted(owners[order], np.arange(len(words)))


def hash_word(word: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # BUCKETS x labels
    transitions: np.ndarray  # labels x labels, log
    lexicon: set[str]

    def emissions(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros((0, len(self.labels)), np.float32)
        features, starts = word_features(words, self.lexicon)
        return np.add.reduceat(self.weights[features], starts, axis=0)


def forward_backward(emissions: np.ndarray, starts: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, pairs: bool = False):
    """Label probabilities of every word of many sequences at once.

    ``emissions``: log scores of all words, a sequence's words lie at start..start + length;
    sequences come longest first. With ``pairs`` also the summed probabilities of neighbouring
    labels and the log likelihood's normaliser.
    """
    e = np.exp(emissions - emissions.max(axis=1, keepdims=True)).astype(np.float64)
    a = np.exp(transitions.astype(np.float64))
    alpha = np.empty_like(e)
    longest = int(lengths[0])
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")  # sequences longer than t
    log_z = 0.0
    for t in range(longest):
        n = active[t]
        at = starts[:n] + t
        now = e[at] if t == 0 else (now[:n] @ a) * e[at]
        scale = now.sum(axis=1, keepdims=True)
        now = now / scale
        alpha[at] = now
        if pairs:
            log_z += float(np.log(scale).sum())
    if pairs:
        log_z += float(emissions.max(axis=1).sum())
    marginal = np.empty_like(e)
    seen = np.zeros_like(a)
    beta = np.ones((len(lengths), e.shape[1]))
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        if t + 1 < longest:
            m = active[t + 1]
            after = e[starts[:m] + t + 1] * beta[:m]
            if pairs:  # summed over sequences without a table of sequences x labels x labels
                before = alpha[starts[:m] + t]
                before = before / ((before @ a) * after).sum(axis=1, keepdims=True)
                seen += a * (before.T @ after)
            b = after @ a.T
            beta[:m] = b / b.sum(axis=1, keepdims=True)
        p = alpha[at] * beta[:n]
        marginal[at] = p / p.sum(axis=1, keepdims=True)
    return (marginal, seen, log_z) if pairs else marginal


def fit(windows: list[tuple[str, list[str]]], seed: int = 1) -> Model:
    """Maximum likelihood by full-batch Adam over sequences of three windows, two out of three of
    which hold a switch."""
    labels = sorted({lang for lang, _ in windows})
    number = {x: i for i, x in enumerate(labels)}
    counts = Counter(w for _, own in windows for w in own)
    lexicon = {w for w, n in counts.items() if n >= LEXICON_COUNT}
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(windows))
    grouped = [order[i : i + 3] for i in range(0, len(order), 3)]
    same: dict[str, list[int]] = {}
    for i in order:
        same.setdefault(windows[i][0], []).append(int(i))
    grouped += [np.array(own[i : i + 3]) for own in same.values() for i in range(0, len(own) // 2, 3)]
    sequences = [[(w, number[windows[i][0]]) for i in g for w in windows[i][1]] for g in grouped]
    sequences = sorted((s for s in sequences if s), key=len, reverse=True)
    vocabulary = {w: i for i, w in enumerate(counts)}
    words = np.array([vocabulary[w] for s in sequences for w, _ in s])
    gold = np.array([y for s in sequences for _, y in s])
    lengths = np.array([len(s) for s in sequences])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    k = len(labels)
    inside = np.ones(len(gold), bool)
    inside[starts] = False
    at = np.flatnonzero(inside)
    gold_pairs = np.zeros((k, k))
    np.add.at(gold_pairs, (gold[at - 1], gold[at]), 1)
    features, first = word_features(list(vocabulary), lexicon)
    owner = np.repeat(np.arange(len(vocabulary)), np.diff(np.append(first, len(features))))
    target = np.eye(k)[gold]
    theta = [np.zeros((BUCKETS, k)), np.zeros((k, k))]
    m, v = [np.zeros_like(x) for x in theta], [np.zeros_like(x) for x in theta]
    total = len(gold)
    for step in range(1, STEPS + 1):
        emission = np.add.reduceat(theta[0][features], first, axis=0)
        marginal, seen, _ = forward_backward(emission[words], starts, lengths, theta[1], pairs=True)
        off = (target - marginal) / total
        by_word = np.stack([np.bincount(words, off[:, j], len(vocabulary)) for j in range(k)], axis=1)
        grad = [
            np.stack([np.bincount(features, by_word[owner, j], BUCKETS) for j in range(k)], axis=1) - 1e-6 * theta[0],
            (gold_pairs - seen) / total - 1e-4 * theta[1],
        ]
        for i, g in enumerate(grad):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            theta[i] = theta[i] + 0.05 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-9)
    return Model(labels, theta[0].astype(np.float32), theta[1], lexicon)


def pieces(word: str) -> list[str]:
    """A word, or a long one in pieces of at most ``LONGEST`` letters."""
    return [word[i : i + LONGEST] for i in range(0, len(word), LONGEST)] if len(word) > LONGEST else [word]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of each text, at places spread over all of it."""
    for b in batches:
        out: list[tuple[str, list[str]]] = []
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
            own = [p for w in text_words(text) for p in pieces(w)]
            step = max(WINDOW, len(own) // WINDOWS)
            out += [(lang, own[i : i + WINDOW]) for i in range(0, min(len(own), step * WINDOWS), step)]
        yield pa.RecordBatch.from_pydict(
            {"lang": pa.array([x for x, _ in out], pa.string()), "words": pa.array([w for _, w in out], pa.list_(pa.string()))}
        )


def train(docs: DataFrame, usable: Column) -> Model | None:
    """Learn from a bounded sample of the rows that ``usable`` admits and that have a language."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    ids = rows.where(usable & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.length("text") > 0)).select("doc_id", "lang").distinct()
    sizes = ids.groupBy("lang").agg(F.count("*").alias("n"))  # one row a language
    most = max(1, min(SAMPLE, TOTAL // max(1, sizes.count())))
    # A share of each language by hash first, three times what is wanted, so that no language is ranked
    # whole in one task.
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30)) * F.col("n") <= 3 * most
    some = ids.join(F.broadcast(sizes), "lang").where(share)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    picked = some.withColumn("place", place).where(F.col("place") <= most).select("doc_id", "lang")
    texts = rows.join(F.broadcast(picked), ["doc_id", "lang"])  # at most TOTAL pairs, or one a language
    found = texts.select("lang", "text").mapInArrow(_windows, "lang string, words array<string>").collect()
    windows = sorted((r["lang"], list(r["words"])) for r in found if r["words"])
    return fit(windows) if windows else None


class Tagger:
    """Texts to label shares; a bounded memo of word emissions."""

    LIMIT = 400_000

    def __init__(self, model: Model):
        self.model = model
        self.memo: dict[str, int] = {}
        self.table = np.zeros((0, len(model.labels)), np.float32)

    def _rows(self, words: list[str]) -> np.ndarray:
        """Rows of ``table`` with the words' emissions."""
        if len(self.memo) > self.LIMIT:
            self.memo, self.table = {}, self.table[:0]
        parts, size, step = [self.table], 0, []
        for w in words:
            if w not in self.memo:
                self.memo[w] = len(self.memo)
                step.append(w)
                size += len(w)
                if size > 200_000:  # a step at a time: the n-grams of words are wider than they
                    parts.append(self.model.emissions(step))
                    size, step = 0, []
        self.table = np.concatenate([*parts, self.model.emissions(step)])
        return np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))

    def _marginals(self, rows: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Groups of texts, longest first: (texts, places of their words, label probabilities)."""
        first = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        order = order[lengths[order] > 0]
        group = np.cumsum(lengths[order]) // GROUP
        for g in np.unique(group).tolist():
            own = order[group == g]
            n = lengths[own]
            starts = np.cumsum(n) - n
            at = np.repeat(first[own] - starts, n) + np.arange(n.sum())
            yield own, at, forward_backward(self.table[rows[at]], starts, n, self.model.transitions)

    def words(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Label probabilities of each word of each text."""
        lengths = np.array([len(t) for t in texts])
        out: list[np.ndarray] = [np.zeros((0, len(self.model.labels)))] * len(texts)
        for own, _, p in self._marginals(self._rows([w for t in texts for w in t]), lengths):
            for i, part in zip(own.tolist(), np.split(p, np.cumsum(lengths[own])[:-1]), strict=True):
                out[i] = part
        return out

    def __call__(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """(language, share of letters) of each text of a column."""
        tokens, numbers, sizes = word_index(texts)
        clean = [clean_word(t.decode("utf-8", "replace")) for t in tokens]
        letters = np.fromiter(map(len, clean), np.int64, len(clean))
        kept = letters[numbers] > 0
        text = np.repeat(np.arange(len(sizes)), sizes)[kept]
        numbers = numbers[kept]
        lengths = np.bincount(text, minlength=len(sizes))
        # The empty word stands in the table for tokens without letters, which no text refers to.
        rows = self._rows(clean)[numbers]
        labels, score = [UNDETERMINED] * len(sizes), np.zeros(len(sizes))
        for own, at, p in self._marginals(rows, lengths):
            weight = letters[numbers[at]].astype(np.float64)
            starts = np.cumsum(lengths[own]) - lengths[own]
            share = np.add.reduceat(p * weight[:, None], starts, axis=0) / np.add.reduceat(weight, starts)[:, None]
            best = share.argmax(axis=1)
            score[own] = np.minimum(1.0, share[np.arange(len(own)), best])
            for i, j in zip(own.tolist(), best.tolist(), strict=True):
                labels[i] = self.model.labels[j]
        return labels, score


def _predict(model: Model | None, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("languages")
        tag = Tagger(model) if model else None
        for b in batches:
            for part in slices(b, "__text"):
                n = part.num_rows
                labels, score = tag(part.column("__text")) if tag else ([UNDETERMINED] * n, np.zeros(n))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in keep), pa.array(labels, pa.string()), pa.array(score)], [*keep, "lang_pred", "score"]
                )

    return run


def predict(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """``keep`` columns, lang_pred and score; a map, no shuffle."""
    rows = docs.select(*keep, F.col("text").cast("string").alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text")
    return rows.mapInArrow(_predict(model, keep), f"{fields}, lang_pred string, score double")
