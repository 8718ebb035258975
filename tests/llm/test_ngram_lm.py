import math
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.llm import common, ngram_lm, queries
from starloom.llm.elias_fano import EliasFano


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=200), st.integers(0, 2**40))
def test_elias_fano_access_and_find(values, extra):
    values = sorted(values)
    e = EliasFano.build(np.array(values, np.uint64), 5001 + extra)
    words = np.concatenate(e.parts())
    e, end = EliasFano.read(words, 0)
    assert end == len(words)
    assert e.access(np.arange(len(values))).tolist() == values
    asked = np.array(sorted({*values, 0, 1, 77, 4999, 5000}), np.uint64)
    got = e.find(asked).tolist()
    for x, i in zip(asked.tolist(), got, strict=True):
        assert (i >= 0 and values[i] == x) if x in values else i == -1


def test_one_select_gives_both_ends_of_a_bucket():
    # Buckets of no, few and many values, runs of ones over several words.
    values = np.unique(np.concatenate([np.arange(5), np.arange(600, 900), [2000, 2001, 4999]])).astype(np.uint64)
    e = EliasFano.build(values, 5000)
    high = np.arange((5000 >> e.bits) + 1)
    start, end = e._between_zeros(high)
    of = (values >> np.uint64(e.bits)).astype(np.int64)
    assert start.tolist() == [(of < h).sum() for h in high] and end.tolist() == [(of <= h).sum() for h in high]
    assert e.find(np.arange(5000)).tolist() == [int(np.searchsorted(values, x)) if x in set(values.tolist()) else -1 for x in range(5000)]


def tokens(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def brute(rows, held):
    """(doc_id, n_tokens, n_known, base, score) with plain dictionaries and exact probabilities."""
    one, two, three, pair = Counter(), Counter(), Counter(), Counter()
    for i, t in rows:
        if not held(i):
            w = tokens(t)
            one.update(w)
            two.update(zip([b"\n", *w[:-1]], w, strict=True))
            for a, b, c in zip([b"\n", *w], w, w[1:]):
                three[a, b, c] += 1
                pair[a, b] += 1
    n, v, k = sum(one.values()), len(one), ngram_lm.KAPPA
    out = []
    for i, t in rows:
        w = tokens(t)
        base = score = 0.0
        for j, x in enumerate(w):
            b = w[j - 1] if j else b"\n"
            p = (one[x] + 1) / (n + v + 1)
            base += math.log10(p)
            p = (two[b, x] + k * p) / (one[b] + k)
            if j:
                a = w[j - 2] if j > 1 else b"\n"
                p = (three[a, b, x] + k * p) / (pair[a, b] + k)
            score += math.log10(p)
        out.append((i, len(w), sum(one[x] > 0 for x in w), base, score))
    return n, out


def compare(got, want):
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in got)
    want = sorted((w[0] is None, w[0] or 0, *w[1:]) for w in want)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(got, want, strict=True):
        assert math.isclose(g[4], w[4], rel_tol=1e-9, abs_tol=1e-9)
        # half a step of the quantiser for each of at most three parts of a token's score
        assert abs(g[5] - w[5]) <= 1.5 * ngram_lm.STEP * g[2] + 1e-6


def test_all_documents_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in common.documents(spark, sf).collect()]
    n, want = brute(rows, lambda i: zlib.crc32(str(i).encode()) % 7 == 2)
    got = queries.op2_lm_scoring(spark, sf).collect()
    assert {r["train_tokens"] for r in got} == {n}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2) for r in got)
    compare(got, want)
    held = [r for r in got if r["held_out"]]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_defined_results_and_split_contexts(spark):
    schema = "doc_id long, text string, score string, n_tokens int, keys int"
    rows = [(i, f"the a{i} the b{i % 5} the c end", None, 1, 1) for i in range(60)]
    rows += [(100, None, None, None, None), (101, "", None, None, None), (None, "the The THE", "x", 1, 1), (102, "unseen words only", None, 1, 1), (7, "the a7 the b2 the c end", None, 1, 1), (103, "w " * 50_000, None, 1, 1)]
    docs = spark.createDataFrame(rows, schema)
    for shards in (1, 7):
        model = ngram_lm.train(docs, F.coalesce(F.col("doc_id") != 102, F.lit(True)), shards=shards)
        if shards == 7:
            assert len(model.hot) and len(model.hot_pairs) and any(s >= 14 for s in model.triples)
        n, want = brute([(r[0], r[1]) for r in rows], lambda i: i == 102)
        assert model.tokens == n
        compare(ngram_lm.score(docs, model, ["doc_id", "keys"]).collect(), want)
    look = ngram_lm.Lookup(model)
    number, _ = look.vocabulary.numbers(np.array([ngram_lm._hash(w) for w in (b"the", b"b1")], np.uint64))
    shard = int(model.pair_shard(number[1:], number[:1])[0])
    after, _ = look._map(f"pairs-{shard}").successors_of(int(number[1]))
    assert after.tolist() == [number[0]]  # "the" alone follows b1
    none = ngram_lm.train(docs, F.lit(False))
    got = ngram_lm.score(docs, none, ["doc_id"]).collect()
    assert all(r["n_known"] == 0 and r["base_score"] == 0 for r in got)
    assert ngram_lm.score(docs.limit(0), none, ["doc_id"]).count() == 0


def test_probabilities_of_a_context_sum_to_one():
    one, two, k = Counter(a=5, b=3, c=2), Counter({("a", "b"): 3, ("a", "c"): 1}), ngram_lm.KAPPA
    n, v = 10, 3
    p = lambda w: (one[w] + 1) / (n + v + 1)
    total = sum((two["a", w] + k * p(w)) / (5 + k) for w in [*one, "unknown"])
    assert total <= 1 + 1e-12
