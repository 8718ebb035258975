import hashlib
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from starloom.llm import common, queries, token_alignment, tokenize

A, B = (tokenize.tokenizer_path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def brute(texts):
    """Whole texts by the tokenizers themselves, all overlaps by their definition."""
    a_tok, b_tok = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_tok.encode_special_tokens = True
    plain = token_alignment.byte_level_alphabet()
    a_name = {i: bytes(plain[c] for c in t) if all(c in plain for c in t) else t.encode() for t, i in a_tok.get_vocab().items()}

    def b_bytes(i):
        p = b_tok.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode()

    def spans(ids, own):
        out, at = [], 0
        for i in ids:
            out.append((i, at, at + len(own(i))))
            at = out[-1][2]
        return out

    found = []
    for t in texts:
        if not t:
            found.append(None)
            continue
        a, b = a_tok.encode(" " + t, add_special_tokens=False).ids, b_tok.encode(t)
        raw = (" " + t).encode()
        if b"".join(a_name[i] for i in a) != raw or b"".join(b_bytes(i) for i in b) != raw:
            found.append(None)
            continue
        sa, sb = spans(a, a_name.__getitem__), spans(b, b_bytes)
        cuts = sorted({x[2] for x in sa} & {x[2] for x in sb})
        groups, start = [], 0
        i = j = 0
        for cut in cuts:
            ga, gb = [], []
            while i < len(sa) and sa[i][2] <= cut:
                ga.append(sa[i][0])
                i += 1
            while j < len(sb) and sb[j][2] <= cut:
                gb.append(sb[j][0])
                j += 1
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
        links, low = [], 0
        for x, s, e in sa:
            while low < len(sb) and sb[low][2] <= s:
                low += 1
            k = low
            while k < len(sb) and sb[k][1] < e:
                links.append((x, sb[k][0]))
                k += 1
        found.append((len(a), len(b), len(groups), links, ";".join(groups)))
    docs = Counter(p for f in found if f for p in set(f[3]))
    best = Counter()
    for (x, _), n in docs.items():
        best[x] = max(best[x], n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        links = f[3]
        n_best = sum(docs[p] == best[p[0]] for p in links)
        out.append((f[0], f[1], f[2], len(links), n_best, sum(docs[p] for p in links), hashlib.sha256(f[4].encode()).hexdigest()))
    return out, docs


def check(spark, docs):
    rows = docs.select("doc_id", "text").collect()
    want, pairs = brute([r["text"] for r in rows])
    got = token_alignment.align(docs, A, B, with_groups=True)
    have = got.documents.collect()
    assert Counter((r["doc_id"], *(r[c] for c in COLUMNS)) for r in have) == Counter((r["doc_id"], *w) for r, w in zip(rows, want, strict=True))
    for r in have:
        assert (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "") == r["groups_sha256"]
    assert {(r["a"], r["b"]): r["docs"] for r in got.pairs.collect()} == dict(pairs)


def test_documents_as_by_brute_force(spark):
    check(spark, common.documents(spark, "/root/testdata/sf0.001"))


def test_query_as_by_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = common.documents(spark, sf).select("doc_id", "text").collect()
    want, _ = brute([r["text"] for r in rows])
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in queries.op11_token_alignment(spark, sf).collect()}
    assert got == {r["doc_id"]: w for r, w in zip(rows, want, strict=True)}


SCHEMA = "doc_id long, text string, n_a string, block int, groups string"


def test_defined_results(spark):
    texts = [
        None, "", " ", "\n", "a", "a", "  two  spaces ", "a▁b", "<|endoftext|> <s> </s>", "tab\tline\n\nend\n", "x　 y \xa0​ z\r\n;\r",
        "é中文 \U0001f600Ⅸ", "don't we'll 12,345.67 é", "word " * 30_000, "y" * 5_000, "\x00 \x1c a\x85 b",
    ]
    check(spark, spark.createDataFrame([(i, t, "x", 1, "g") for i, t in enumerate(texts)], SCHEMA))
    # Repeated rows, one id with two texts, no id.
    check(spark, spark.createDataFrame([(d, t, None, None, None) for d, t in [(1, "a b"), (1, "a b"), (1, "other"), (None, "a b"), (None, None)]], SCHEMA))
    check(spark, spark.createDataFrame([], SCHEMA))


def test_segments_and_blocks_do_not_matter(spark, monkeypatch):
    text = "One, two; three\n four  five. " * 400
    whole = token_alignment.Aligner(A, B)
    want = token_alignment._Part(whole, [text, "x"], True)
    monkeypatch.setattr(token_alignment, "MEMO", 3)
    monkeypatch.setattr(token_alignment, "LINKS", 50)
    monkeypatch.setattr(token_alignment, "SEGMENT", 100)
    assert "".join(token_alignment.segments(text, 100)) == text and len(list(token_alignment.segments(text, 100))) > 50
    got = token_alignment._Part(token_alignment.Aligner(A, B), [text, "x"], True)
    assert ["".join(g) for g in got.groups] == ["".join(g) for g in want.groups] and (got.totals == want.totals).all()
    assert [h.hexdigest() for h in got.digest] == [h.hexdigest() for h in want.digest]
    assert (got.pairs == want.pairs).all() and (got.times == want.times).all()


def test_same_bytes_by_id_and_pieces_into_white_space(monkeypatch):
    own = token_alignment.Aligner(A, B)
    assert (own.same >= 0).sum() > 10_000
    assert all(own.bytes_a[a] == own.bytes_b[b] for a, b in enumerate(own.same) if b >= 0)

    class Crossing(sentencepiece.SentencePieceProcessor):
        def id_to_piece(self, i):
            return "a\u2581b" if i == 300 else super().id_to_piece(i)

    monkeypatch.setattr(token_alignment.sentencepiece, "SentencePieceProcessor", Crossing)
    with pytest.raises(ValueError, match="white space"):
        token_alignment.Aligner(A, B)
