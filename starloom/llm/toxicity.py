"""Toxicity scores over deobfuscated text.

``deobfuscate`` restores disguised words; evidence is then gathered from the distinct restored
words. A word's evidence is the best lower confidence bound on the log odds of its features (the
word itself, its first four to seven letters where several words support them), learned from
labelled documents; a logistic curve over a document's strongest and summed evidence and its number
of distinct words gives the score. The curve is fitted on evidence from the other half of the documents.

Every usable labelled document is learned from: trigrams, features and the curve are counted and summed
over all of them. The size of the model is bounded: ``FEATURES`` features and the ``GRAMS`` most frequent
character trigrams are kept (Latin, Greek or Cyrillic texts have fewer; in a script of thousands of signs
the rarer trigrams are left to the bigrams and single signs of the model).

Defined results: null and empty texts get the score of a text without evidence; very long texts are read
whole; repeated rows get equal scores, of several labels of an id the toxic one counts; ties among
features go by their text; without a usable label every score is 0; labels null or outside 0/1 are not learned;
an empty table gives no rows. Columns besides ``keep``, doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import claim, materialize, slices, word_index
from starloom.llm.deobfuscate import CharModel, Restorer, is_plain
from starloom.operators.screen import key_bitmaps, may_be_among, slots_for

FEATURES = 20_000
GRAMS = 100_000
THRESHOLD = 0.7
TOXIC_WEIGHT = 0.2
PREFIXES = (4, 5, 6, 7)
# A prefix counts only if at least so many distinct words (bits of a 64-bit sketch) carry it.
LEAST_WORDS = 4
# Features (or words) a task counts before it hands its counts on, and words whose evidence it remembers.
HELD, KNOWN = 250_000, 200_000


def features(word: str) -> list[str]:
    return [f"={word}", *(word[:k] for k in PREFIXES if len(word) >= k)]


@dataclass
class Model:
    chars: CharModel
    weight: dict[str, float] = field(default_factory=dict)
    curve: tuple[float, ...] = (-50.0, 0.0, 0.0, 0.0)
    known: dict[str, float] = field(default_factory=dict)

    def evidence(self, words: set[str]) -> tuple[float, float, float]:
        """(strongest, log of 1 + sum, log of 1 + number) over the distinct words of a text."""
        known, get = self.known, self.weight.get
        new = words.difference(known)
        if len(known) + len(new) > KNOWN:
            known.clear()
            new = words
        for w in new:
            known[w] = max(get(f, 0.0) for f in features(w))
        best = [*filter(None, map(known.__getitem__, words))]
        return max(best, default=0.0), math.log1p(math.fsum(best)), math.log1p(len(words))

    def score(self, words: set[str]) -> float:
        z = self.curve[0] + sum(c * x for c, x in zip(self.curve[1:], self.evidence(words), strict=True))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def labelled_texts(docs: DataFrame, labels: DataFrame, usable: Column) -> DataFrame:
    """(doc_id, text, toxic) of every document with a usable label.

    Bitmaps of the labelled ids (two to four bytes an id) are broadcast, so that hardly any text without a
    label is shuffled to the labels; the join decides.
    """
    kept = labels.where(usable & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    kept = materialize(kept.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")), "toxicity-labels")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = texts.schema["doc_id"].dataType
    # A hash tells ids apart as the join does if both are of one type without two forms of a value.
    if kind == kept.schema["doc_id"].dataType and isinstance(kind, (T.IntegralType, T.StringType)):
        slots = slots_for(kept.count())
        texts = may_be_among(texts, key_bitmaps(kept, ["doc_id"], slots), slots, ["doc_id"])
    return texts.join(kept, "doc_id")


def parts(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    return (part for b in batches for part in slices(b, column))


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Character trigrams of the distinct plain words of each text."""
    claim("toxicity")
    seen: Counter[str] = Counter()
    own: Counter[str] = Counter()

    def spell() -> None:
        for w, n in own.items():
            if is_plain(w):
                for g in CharModel.grams(w):
                    seen[g] += n
        own.clear()

    for b in parts(batches):
        for t in b.column("text").to_pylist():
            own.update(set((t or "").lower().split()))
        if len(own) >= HELD:
            spell()
    spell()
    yield pa.RecordBatch.from_pydict({"gram": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})


def char_model(grams: DataFrame) -> CharModel:
    """The model of all trigrams (gram, n), each once. They are bounded by the alphabet; the most frequent keep
    the driver's part small, the shorter ones are counted over all."""

    def most(rows: DataFrame) -> dict[str, int]:
        return {r["gram"]: r["n"] for r in rows.orderBy(F.desc("n"), "gram").limit(GRAMS).collect()}

    def ending(size: int) -> DataFrame:
        return grams.groupBy(F.substring("gram", 4 - size, size).alias("gram")).agg(F.sum("n").alias("n"))

    tri = most(grams)
    if len(tri) < GRAMS:  # all of them
        return CharModel(tri)
    return CharModel(tri, most(ending(2)), {r["gram"]: r["n"] for r in ending(1).collect()})


COUNTS = ("c0", "t0", "c1", "t1")  # clean and toxic documents in either half


def _restore(chars: CharModel):
    """The distinct restored words of each row, which hold no white space, as one text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity")
        restore = Restorer(chars)
        for b in parts(batches):
            words = [" ".join(sorted(restore(t))) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), b.column("toxic"), b.column("half")], ["words", "toxic", "half"])

    return run


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of either half and label hold a feature, and a sketch of the words that carry it."""
    claim("toxicity")
    number: dict[str, int] = {}
    counts, bits = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def counted() -> pa.RecordBatch:
        columns = {c: pa.array(counts[i :: len(COUNTS)]) for i, c in enumerate(COUNTS)}
        return pa.RecordBatch.from_pydict({"feature": pa.array(list(number), pa.string()), **columns, "bits": pa.array(bits.view(np.int64))})

    for b in parts(batches, "words"):
        words, at, sizes = word_index(b.column("words"))
        # Row by row the features of each distinct word, -1 where it has fewer.
        of = np.full((len(words), 1 + len(PREFIXES)), -1, np.int64)
        sketch = np.zeros(len(words), np.uint64)
        for i, w in enumerate(words):
            own = [number.setdefault(f, len(number)) for f in features(w.decode("utf-8", "surrogatepass"))]
            of[i, : len(own)] = own
            sketch[i] = 1 << (xxhash.xxh3_64_intdigest(w) & 63)
        n = len(number)
        counts = np.concatenate([counts, np.zeros(n * len(COUNTS) - len(counts), np.int64)])
        bits = np.concatenate([bits, np.zeros(n - len(bits), np.uint64)])
        np.bitwise_or.at(bits, of[of >= 0], np.broadcast_to(sketch[:, None], of.shape)[of >= 0])
        # A feature counts once a document, however many of its words carry it.
        rows = np.repeat(np.arange(b.num_rows), sizes)
        found = of[at]
        pairs = np.unique((rows[:, None] * n + found)[found >= 0]) if n else np.zeros(0, np.int64)
        group = 2 * b.column("half").to_numpy().astype(np.int64) + b.column("toxic").to_numpy()
        counts += np.bincount(len(COUNTS) * (pairs % max(n, 1)) + group[pairs // max(n, 1)], minlength=len(counts))
        if n >= HELD:
            yield counted()
            number.clear()
            counts, bits = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    yield counted()


def _evidence(blob: bytes):
    """Evidence of each row under the weights of the half it is not in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity")
        models = pickle.loads(blob)
        for b in parts(batches, "words"):
            rows = zip(b.column("words").to_pylist(), b.column("half").to_pylist(), strict=True)
            x = [models[1 - half].evidence(set(words.split())) for words, half in rows]
            yield pa.RecordBatch.from_pydict(
                {c: pa.array([v[i] for v in x], pa.float64()) for i, c in enumerate(("top", "total", "n"))}
                | {"toxic": b.column("toxic").cast(pa.int32())}
            )

    return run


def bound(toxic: float, clean: float, n_toxic: int, n_clean: int) -> float:
    """Two standard errors below the smoothed log odds ratio."""
    odds = math.log(((toxic + 0.5) / (n_toxic + 1)) / ((clean + 0.5) / (n_clean + 1)))
    return odds - 2 * math.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))


def fit_curve(rows: DataFrame, n_toxic: int, n_clean: int, ridge: float = 1e-2, steps: int = 50) -> tuple[float, ...]:
    """Logistic regression by Newton's method over (top, total, n, toxic); each step is one aggregate of 14
    sums over all rows. Toxic rows weigh TOXIC_WEIGHT in all, clean ones the rest, whatever their numbers."""
    x = [F.lit(1.0), *(F.col(c) for c in ("top", "total", "n"))]
    weight = F.when(F.col("toxic") == 1, F.lit(TOXIC_WEIGHT / n_toxic)).otherwise(F.lit((1 - TOXIC_WEIGHT) / n_clean))
    w = np.zeros(len(x))
    pairs = [(i, j) for i in range(len(x)) for j in range(i + 1)]
    for _ in range(steps):
        z = sum((F.lit(float(c)) * v for c, v in zip(w[1:], x[1:], strict=True)), F.lit(float(w[0])))
        p = 1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-40.0)), F.lit(40.0))))
        of = rows.select("top", "total", "n", weight.alias("weight"), "toxic", p.alias("p"))
        slope = F.col("weight") * (F.col("p") - F.col("toxic"))
        bend = F.col("weight") * F.greatest(F.col("p") * (1 - F.col("p")), F.lit(1e-9))
        sums = of.agg(*(F.sum(slope * v).alias(f"g{i}") for i, v in enumerate(x)), *(F.sum(bend * x[i] * x[j]).alias(f"h{i}{j}") for i, j in pairs)).first()
        grad = np.array([sums[f"g{i}"] for i in range(len(x))]) + ridge * w / 100
        hess = ridge * np.eye(len(w)) / 100
        for i, j in pairs:
            hess[i, j] += sums[f"h{i}{j}"]
            hess[j, i] = hess[i, j]
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def train(docs: DataFrame, labels: DataFrame, usable: Column) -> Model:
    """Learn from every labelled document that ``usable`` (over the labels' doc_id) admits."""
    half = F.when(F.xxhash64(F.lit(7), "doc_id") % 2 == 0, 0).otherwise(1).alias("half")
    rows = materialize(labelled_texts(docs, labels.select("doc_id", "toxic"), usable).select("text", "toxic", half), "toxicity-labelled", "zstd")
    grams = rows.select("text").mapInArrow(_count_grams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    model = Model(char_model(materialize(grams, "toxicity-grams")))
    # Restored once; counted and weighed from there.
    rows = materialize(rows.mapInArrow(_restore(model.chars), "words string, toxic int, half int"), "toxicity-words", "zstd")
    counted = (
        rows.mapInArrow(_count_features, f"feature string, {', '.join(f'{c} long' for c in COUNTS)}, bits long")
        .groupBy("feature")
        .agg(*(F.sum(c).alias(c) for c in COUNTS), F.bit_count(F.bit_or("bits")).alias("words"))
    )
    size = dict.fromkeys([(h, t) for h in (0, 1) for t in (0, 1)], 0)
    size |= {(r["half"], r["toxic"]): r["n"] for r in rows.groupBy("half", "toxic").agg(F.count("*").alias("n")).collect()}
    if not all(size.values()):
        return model
    # Only features that lean to toxic; the FEATURES most frequent of them in toxic documents.
    lean = F.expr(f"(t0 + t1) * {size[0, 0] + size[1, 0]} > (c0 + c1) * {size[0, 1] + size[1, 1]}")
    whole_word = F.col("feature").startswith("=")
    kept = counted.where(lean & F.expr("t0 + t1 >= 3") & (whole_word | (F.col("words") >= LEAST_WORDS)))
    kept = kept.orderBy(F.desc(F.expr("t0 + t1")), "feature").limit(FEATURES).collect()

    # The word that brings a prefix most of its toxic documents: the prefix must hold without it, so
    # that ``lose`` does not live on ``loser``.
    main: dict[str, Row] = {}
    for r in kept:
        if r["feature"].startswith("="):
            word = r["feature"][1:]
            for f in features(word)[1:]:
                if f not in main or r["t0"] + r["t1"] > main[f]["t0"] + main[f]["t1"]:
                    main[f] = r

    def weights(halves: tuple[int, ...]) -> dict[str, float]:
        n_t, n_c = sum(size[h, 1] for h in halves), sum(size[h, 0] for h in halves)

        def odds(r: Row, less: Row | None = None) -> float:
            t, c = (sum(r[f"{x}{h}"] - (less[f"{x}{h}"] if less else 0) for h in halves) for x in "tc")
            return bound(max(t, 0), max(c, 0), n_t, n_c)

        w = {r["feature"]: min(odds(r), odds(r, main.get(r["feature"]))) for r in kept}
        return {f: x for f, x in w.items() if x > 0.3}

    model.weight = weights((0, 1))
    halves = (Model(CharModel({}), weights((0,))), Model(CharModel({}), weights((1,))))
    seen = rows.mapInArrow(_evidence(pickle.dumps(halves)), "top double, total double, n double, toxic int")
    model.curve = fit_curve(materialize(seen, "toxicity-evidence"), size[0, 1] + size[1, 1], size[0, 0] + size[1, 0])
    return model


def _score(blob: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity")
        model = pickle.loads(blob)
        restore = Restorer(model.chars)
        for b in parts(batches, "__text"):
            s = [model.score(restore(t)) for t in b.column("__text").to_pylist()]
            kept = [n for n in b.schema.names if n != "__text"]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in kept), pa.array(s, pa.float64())], [*kept, "score"])

    return run


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and the score; a map over the rows, no shuffle."""
    rows = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text"), "score double"])
    return rows.mapInArrow(_score(pickle.dumps(model)), schema)
