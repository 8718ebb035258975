import numpy as np

from starloom.llm import common, mih, queries


def brute(rows, is_query, k=5):
    """query_id -> [(score, vec_id)] over all rows, in double precision."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    n = np.linalg.norm(x, axis=1)
    out = {}
    for i, v, m in zip(ids, x, n, strict=True):
        if is_query(i):
            s = x @ v / (n * m)
            order = sorted((-c, j) for c, j in zip(s.tolist(), ids.tolist(), strict=True) if j != i)[:k]
            out[int(i)] = [(-c, j) for c, j in order]
    return out


def test_index_returns_every_code_within_the_radius():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 256, (800, mih.BITS // 8), dtype=np.uint8)
    codes[::7] = codes[3] ^ (rng.random((len(codes[::7]), mih.BITS // 8)) < 0.2).astype(np.uint8)
    index = mih.Index(codes)
    for radius in (0, 5, 16, 40, 55, 128):
        for q in (3, 10):
            apart = mih.hamming(codes[q : q + 1], codes)[0]
            assert index.within(codes[q], radius).tolist() == np.flatnonzero(apart <= radius).tolist()


def test_recall_on_all_embeddings(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in common.table(spark, sf, "embeddings").collect()]
    want = brute(rows, lambda i: i % 50 == 0)
    got = {}
    for r in queries.op3_multi_index_hashing(spark, sf).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["score"], r["vec_id"])
    assert set(got) == set(want) and all(sorted(g) == [1, 2, 3, 4, 5] for g in got.values())
    exact = dict(rows)
    hits = 0
    for q, own in got.items():
        hits += len({j for _, j in own.values()} & {j for _, j in want[q]})
        for s, j in own.values():
            a, b = np.array(exact[q], float), np.array(exact[j], float)
            assert abs(s - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12
        assert [own[r] for r in range(1, 6)] == sorted(own.values(), key=lambda x: (-x[0], x[1]))
    assert hits >= 0.95 * 5 * len(want)


def test_copies_ties_and_defined_results(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(100, 140)]
    same = [1.0] + [0.0] * 7
    rows += [(i, same) for i in range(0, 60)]
    odd = [(200, None), (201, [0.0] * 8), (202, [float("nan")] * 8), (203, [float("inf")] + [0.0] * 7), (204, [None] + [1.0] * 7), (205, [1.0]), (None, same), (3, same)]
    schema = "vec_id long, embedding array<float>, first int, ids string, v int"
    df = spark.createDataFrame([(*r, 1, "x", None) for r in rows + odd], schema)
    got = mih.nearest(df, lambda i: i % 50 == 0).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r["query_id"], []).append(r["vec_id"])
    assert by[0] == [1, 2, 3, 4, 5] and by[50] == [0, 1, 2, 3, 4] and set(by) == {0, 50, 100}
    want = brute([(i, np.array(v, np.float32).tolist()) for i, v in rows], lambda i: i == 100)[100]
    assert by[100] == [j for _, j in want]
    few = mih.nearest(df.where("vec_id in (0, 101, 102)"), lambda i: i % 50 == 0).collect()
    assert len(few) == 2 and {r["vec_id"] for r in few} == {101, 102}
    assert mih.nearest(df.limit(0), lambda i: i % 50 == 0).count() == 0
    assert mih.nearest(df.where("vec_id = 0").limit(1), lambda i: i % 50 == 0).count() == 0
