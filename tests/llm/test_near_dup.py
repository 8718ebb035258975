import random

import numpy as np

from starloom.llm import common, near_dup, queries
from starloom.llm.shingles import shingle_set


def shingle_tuples(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(rows, percent):
    """doc_id -> (set size, smallest reachable id) by comparing all pairs that share a shingle."""
    sets = [(i, shingle_tuples(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = {}
    for k, (_, s) in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(k)
    tried = set()
    for own in where.values():
        for n, a in enumerate(own):
            for b in own[n + 1 :]:
                if (a, b) in tried:
                    continue
                tried.add((a, b))
                (i, s), (j, t) = sets[a], sets[b]
                if 100 * len(s & t) >= percent * len(s | t):
                    x, y = find(i), find(j)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def test_shingle_set_sizes():
    for t in [None, "", " \t\n", "One", "one two", "A b c d e", "a b c d e f a b c d e f", "x " * 5000, "é ü y"]:
        assert len(shingle_set(t)) == len(shingle_tuples(t))
    assert (shingle_set("A B") == shingle_set(" a\tb ")).all()


def test_estimate_from_packed_signatures():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    m = near_dup.minima([np.unique(base[:3000]), np.unique(base[300:3300])])
    low = m & np.uint64(15)
    equal = (low[0] == low[1]).mean()
    assert abs((equal - 1 / 16) * 16 / 15 - 2700 / 3300) < 0.15
    packed = near_dup.pack(m)
    x = (packed[0] ^ packed[1]).view(np.uint64)
    nibbles = [(int(v) >> s) & 15 for v in x for s in range(0, 64, 4)]
    assert sum(n == 0 for n in nibbles) == (low[0] == low[1]).sum()


def test_all_documents_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    want = brute([(r["doc_id"], r["text"]) for r in common.documents(spark, sf).collect()], 85)
    got = queries.op7_minhash(spark, sf).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert any(not r["kept"] for r in got)


def test_chains_copies_nulls_and_empty(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(5000)]
    base = [rng.choice(vocabulary) for _ in range(300)]
    rows, text = [], list(base)
    for i in range(40):  # each step alters a little: neighbours link, ends do not
        rows.append((100 + i, " ".join(text)))
        for _ in range(2):
            text[rng.randrange(300)] = rng.choice(vocabulary)
    rows += [(i, " ".join(base)) for i in range(300, 330)]
    rows += [(1, None), (2, ""), (3, "a b"), (4, "A  b"), (5, "word " * 30_000), (6, "word " * 20_000)]
    want = brute(rows, 85)
    schema = "doc_id long, text string, cls string, label int, sig0 string, bucket int"
    full = [(*r, "x", 1, None, None) for r in [*rows, (5, "word " * 30_000), (None, "a b"), (None, None)]]
    got = near_dup.near_duplicates(spark.createDataFrame(full, schema), 85).collect()
    assert len(got) == len(full)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == want
    assert sorted(((r["component_id"] or 0) for r in got if r["doc_id"] is None)) == [0, 3]
    empty = near_dup.near_duplicates(spark.createDataFrame([], schema), 85)
    assert empty.count() == 0


def test_small_buckets_whose_leaders_coincide(spark):
    """Buckets of three and four texts with one or two distinct leaders: a link between texts that lead
    nothing is not lost. Groups whose picks coincide are looked for among many random ones."""
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(100_000)]
    rows, n = [], 0
    for group in range(60):
        # A hub, and three texts 0.80-0.84 from it; two of these are near each other.
        hub = [rng.choice(vocabulary) for _ in range(400)]
        for k in range(2 + group % 3):
            own = list(hub)
            own[30 * k : 30 * k + 37] = [rng.choice(vocabulary) for _ in range(37)]
            rows.append((n, " ".join(own)))
            twin = list(own)
            twin[395:400] = [rng.choice(vocabulary) for _ in range(5)]
            rows.append((n + 1, " ".join(twin)))
            n += 2
        rows.append((n, " ".join(hub)))
        n += 1
    want = brute(rows, 85)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert len({c for _, c in want.values()}) > 60
