import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starloom.llm import common, packing, queries, tokenize


def brute_ids(tok, text):
    return [*tok.encode(text or "", add_special_tokens=False).ids, 2]


def test_word_memo_equals_whole_texts():
    tok = Tokenizer.from_file(tokenize.tokenizer_path())
    texts = ["", None, "a b c \x1cq ́x İI ΣΑΣ it's IT'S 12½ ²³ Ⅷ x<|startoftext|>y \x85z​", "日本語 テ",
             "á ́b é é.", " \n\t ", "don't  we'll\x0bq'\x0cs ...!? A.B. Hello, hello HELLO!!", "word " * 40_000]
    got = tokenize.Encoder(tokenize.tokenizer_path()).encode_all(texts)
    for t, b in zip(texts, got, strict=True):
        assert np.frombuffer(b, "<u2").tolist() == brute_ids(tok, t)
    # On request the strings of special tokens are plain text.
    tok.encode_special_tokens = True
    got = tokenize.Encoder(tokenize.tokenizer_path(), plain=True).encode_all(texts)
    assert [np.frombuffer(b, "<u2").tolist() for b in got] == [brute_ids(tok, t) for t in texts]


def test_strings_of_special_tokens_give_their_ids():
    tok = Tokenizer.from_file(tokenize.tokenizer_path())
    texts = ["x <|endoftext|> y", "a<|startoftext|>b <|ENDOFTEXT|>.", "<|endoftext|><|endoftext|> so", "word <|endoftext|>, " * 2000]
    got = tokenize.encoder(tokenize.tokenizer_path()).encode_all(texts)
    assert [np.frombuffer(b, "<u2").tolist() for b in got] == [brute_ids(tok, t) for t in texts]
    assert np.frombuffer(got[0], "<u2").tolist() == [343, 49407, 344, 2]


def test_words_of_signs_and_digits_are_looked_up_by_their_pieces():
    tok = Tokenizer.from_file(tokenize.tokenizer_path())
    enc = tokenize.Encoder(tokenize.tokenizer_path())
    texts = ["Re%%% it's we'LL don't. 'tis '' a'b 1,234.5 x=<y> <| |> <|endoftext|>x", "ÀÉÎõü Straße. ÿ!? İstanbul ΣΑΣ. \u00b5m ªº naïve... cafe\u0301 ×÷", None,
             "\x00 a\x1cb \x7f \x85x a\u00a0b \u3042\u3044", " ... ", "..,;! A.B.C :-) 's"]
    for _ in range(2):  # first met, then known
        got = enc.encode_all(texts)
        assert [np.frombuffer(b, "<u2").tolist() for b in got] == [brute_ids(tok, t) for t in texts]
    assert {"re", "%%%", "'ll", "straße", "...", "7f"} & set(enc.memo) == {"re", "%%%", "'ll", "straße", "..."}


def check_plan(hist, window, slack=2):
    plan = packing.make_plan(hist, window, slack, first=5)
    filled = {}
    for n in range(1, window):
        for rank in range(int(hist[n])):
            own = plan.place(n, rank)
            assert [p[0] for p in own] == [sum(q[1] for q in own[:i]) for i in range(len(own))] and sum(p[1] for p in own) == n
            for _, m, seq, off in own:
                filled.setdefault(seq, []).append((off, m))
    for own in filled.values():
        at = 0
        for off, m in sorted(own):
            assert off == at
            at += m
        assert at <= window and (at >= window - slack or at & (at - 1) == 0)
    assert sorted(filled) == list(range(5, plan.sequences))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=31, max_size=31))
def test_plan_places_every_document_once_without_gaps(counts):
    check_plan(np.array([0, *counts], np.int64), 32)


def test_plan_edge_cases():
    for counts in [{}, {1: 1}, {31: 1}, {16: 7}, {3: 1000}, {31: 5000, 1: 4000, 2: 17}]:
        hist = np.zeros(32, np.int64)
        for n, k in counts.items():
            hist[n] = k
        check_plan(hist, 32)


def test_nnls_meets_the_optimality_conditions():
    rng = np.random.default_rng(0)
    hist = rng.integers(0, 50, 64).astype(float)
    cols = [(a, 63 - a) for a in range(1, 32)] + [(a, a, 63 - 2 * a) for a in range(1, 20)]
    x, left = packing.nnls(cols, hist, np.zeros(len(cols)), 5000)
    grad = np.array([sum(left[i] for i in c) for c in cols])
    assert (x >= 0).all() and grad.max() < 1.5 and abs(grad[x > 1e-6]).max() < 1.5


def test_all_documents(spark):
    sf = "/root/testdata/sf0.01"
    tok = Tokenizer.from_file(tokenize.tokenizer_path())
    texts = {r["doc_id"]: r["text"] for r in common.documents(spark, sf).collect()}
    rows = queries.op4_packing(spark, sf).collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for d, own in by_doc.items():
        ids, at = brute_ids(tok, texts[d]), 0
        for r in sorted(own, key=lambda r: r["start"]):
            piece = np.array(ids[at : at + r["length"]], "<u4")
            assert r["start"] == at and r["doc_tokens"] == len(ids) and zlib.crc32(piece.tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    padding = total = 0
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert 0 < at <= 4096
        total += at
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    assert padding < 0.005 * total


def test_defined_results(spark):
    schema = "doc_id long, text string, n long, ids string, rid int"
    rows = [(1, None, 1, None, 1), (None, "", 1, None, 1), (3, "word " * 20_000, 1, None, 1), (3, "word " * 20_000, 1, None, 1), (4, "a b", None, None, None)]
    pieces = packing.pack(spark.createDataFrame(rows, schema), tokenize.tokenizer_path())
    got = pieces.collect()
    assert sum(r["length"] for r in got) == 1 + 1 + 2 * 20_001 + 3
    whole = packing.sequences(pieces).collect()
    assert sum(len(r["ids"]) for r in whole) == 4 * sum(r["length"] for r in got)
    assert packing.pack(spark.createDataFrame([], schema), tokenize.tokenizer_path()).count() == 0
