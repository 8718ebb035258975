import os

import numpy as np
import pytest
from tokenizers import Tokenizer

from starloom.llm import common, queries, tokenize
from starloom.llm import training_order as order


def test_permutation_is_a_bijection_and_inverts():
    for n in [1, 2, 3, 7, 64, 1000, 65_537]:
        slots = order.permute(np.arange(n), n, "k")
        assert sorted(slots.tolist()) == list(range(n))
        assert (order.unpermute(slots, n, "k") == np.arange(n)).all()
    assert (order.permute(np.arange(100), 100, "a") != order.permute(np.arange(100), 100, "b")).any()


def check(spark, docs, shard=64, stride=64):
    tok = Tokenizer.from_file(tokenize.tokenizer_path())
    rows, root, total = order.materialise(docs, tokenize.tokenizer_path(), "key", stride=stride, shard=shard)
    got = rows.collect()
    n = -(-total // stride)
    assert rows.count() == len(got)  # the index is read again, nothing is written again
    assert sorted({r["slot"] for r in got}) == list(range(n)) and sum(r["length"] for r in got) == total
    want = sorted(
        (r["doc_id"] is None, r["doc_id"] or 0, [*tok.encode(r["text"] or "", add_special_tokens=False).ids, 2])
        for r in docs.select("doc_id", "text").collect()
    )
    if not total:
        assert not want and not list(order.ShardReader(root).read())
        return
    reader = order.ShardReader(root)
    read = dict(reader.read())
    assert sorted(read) == list(range(n)) and all(len(x) == stride for s, x in read.items() if s != reader.last)
    assert [s for s, _ in reader.read(n // 2)] == list(range(n // 2, n))  # resumes anywhere
    # An exact round trip: sequences back in corpus order are the documents one after another.
    back = order.unpermute(np.arange(n), n, "key")
    stream = np.concatenate([read[s] for s in np.argsort(back)])
    docs_back = []
    for r in sorted((r for r in got if r["start"] == 0), key=lambda r: back[r["slot"]] * stride + r["offset"]):
        docs_back.append((r["doc_id"] is None, r["doc_id"] or 0, int(back[r["slot"]] * stride + r["offset"])))
    ends = [x[2] for x in docs_back[1:]] + [total]
    assert sorted((a, d, stream[s:e].tolist()) for (a, d, s), e in zip(docs_back, ends, strict=True)) == want


def test_round_trip_of_documents(spark):
    check(spark, common.documents(spark, "/root/testdata/sf0.001"), shard=512, stride=256)


def test_defined_results(spark):
    schema = "doc_id long, text string, slot int, ids string, first int"
    rows = [(1, None, 1, None, 1), (None, "", 1, None, 1), (3, "word " * 20_000, 1, None, 1), (3, "word " * 20_000, 1, None, 1), (4, "a b", None, None, None)]
    check(spark, spark.createDataFrame(rows, schema))
    check(spark, spark.createDataFrame([], schema))


def test_a_folder_without_manifest_is_refused(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    _, root, _ = order.materialise(docs, tokenize.tokenizer_path(), "key")
    folder = common.local_path(root)
    os.rename(f"{folder}/{order.MANIFEST}", f"{folder}/not-yet")
    with pytest.raises(FileNotFoundError, match="complete"):
        order.ShardReader(root)


def test_query_places_every_piece(spark):
    """Slots, offsets and bytes of all pieces, from the permutation and the tokenizer alone."""
    sf = "/root/testdata/sf0.001"
    tok = Tokenizer.from_file(tokenize.tokenizer_path())
    size = {r["doc_id"]: len(tok.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in common.documents(spark, sf).collect()}
    got = queries.op8_training_order(spark, sf).collect()
    n = -(-sum(size.values()) // order.STRIDE)
    back = order.unpermute(np.array([r["slot"] for r in got]), n, "epoch-0")
    at = {}
    for r, seq in zip(got, back.tolist(), strict=True):
        assert r["shard"] == r["slot"] // order.SHARD
        offset = r["byte_offset"] // 2 - r["slot"] % order.SHARD * order.STRIDE
        assert 0 <= offset and offset + r["length"] <= order.STRIDE
        at.setdefault(r["doc_id"], []).append((r["start"], r["length"], seq * order.STRIDE + offset))
    places = []
    for doc, own in at.items():
        own.sort()
        base = own[0][2]
        assert own[0][0] == 0 and sum(m for _, m, _ in own) == size[doc]
        assert all(place == base + start for start, _, place in own)  # one run in the corpus
        places.append((base, base + size[doc]))
    places.sort()
    assert places[0][0] == 0 and all(a[1] == b[0] for a, b in zip(places, places[1:])) and set(at) == set(size)


def test_query_covers_all_documents(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.op8_training_order(spark, sf)
    ids = {r["doc_id"] for r in got.select("doc_id").distinct().collect()}
    assert ids == {r["doc_id"] for r in common.documents(spark, sf).select("doc_id").collect()}
