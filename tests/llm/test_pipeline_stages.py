import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as cp
from starloom.llm import common, decontaminate, secrets, tokenize
from starloom.llm.near_dup import near_duplicates
from tests.llm.test_near_dup import brute as brute_classes

SF = "/root/testdata/sf0.01"


def test_stages_take_effect_and_keep_the_rest(spark):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    docs = common.documents(spark, SF)
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    start = ids(docs)
    kept = {}
    for name, stage in cp.STAGES[:-1]:
        before, docs = docs, common.materialize(stage(spark, docs, SF), f"t-{name}")
        assert docs.columns == cp.COLUMNS and docs.count() == len(ids(docs))
        kept[name] = ids(docs)
        if name == "near_duplicates":
            classes = brute_classes([(r["doc_id"], r["text"]) for r in before.collect()], 80)
            assert kept[name] == {i for i, (_, least) in classes.items() if i == least}
        if name == "decontamination":
            leaked = ids(decontaminate.contaminated(before, common.table(spark, SF, "benchmark")))
            assert leaked and kept[name] == ids(before) - leaked
        if name == "secrets":
            old = {r["doc_id"]: r["text"] for r in before.collect()}
            scan, changed = secrets.Scanner(), 0
            for r in docs.collect():
                found = scan(old[r["doc_id"]])
                assert r["text"] == (secrets.redact(old[r["doc_id"]], found) if found else old[r["doc_id"]])
                assert not found or (scan(r["text"]) == [] and r["n_chars"] == len(r["text"]))
                changed += bool(found)
            assert changed and kept[name] == ids(before)
    labels = {r["doc_id"]: r["toxic"] for r in common.table(spark, SF, "labels").collect()}
    clean = [i for i in start if labels.get(i) == 0]
    assert sum(i in kept["toxicity"] for i in clean) >= 0.97 * len(clean)
    assert len(kept["toxicity"]) < len(start)
    pieces = cp.STAGES[-1][1](spark, docs, SF).collect()
    enc = tokenize.Encoder(tokenize.tokenizer_path())
    want = {r["doc_id"]: len(enc.encode_all([r["text"]])[0]) // 2 for r in docs.collect()}
    got = {}
    for p in pieces:
        got[p["doc_id"]] = got.get(p["doc_id"], 0) + p["length"]
    assert got == want and np.all([p["offset"] + p["length"] <= 4096 for p in pieces])


def test_edge_rows_pass_all_stages(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "token=abcdefgh1 here", None, None, None), (None, None, None, None, None),
            (3, "word " * 30_000, "en", "s", 9), (3, "word " * 30_000, "en", "s", 9), (4, "a b c", None, "x", 5)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, cls string, findings int")
    for _, stage in cp.STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, "/root/testdata/sf0.001"), "t-edge")
    left = sorted(((r["doc_id"] or 0), r["text"] or "") for r in docs.collect())
    assert [i for i, _ in left] == [0, 0, 1, 2, 3, 4] and left[1][1] == "[SECRET] here"
    assert cp.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").count() >= 6
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in cp.STAGES:
        out = stage(spark, empty, "/root/testdata/sf0.001")
        assert out.count() == 0


def test_near_duplicates_of_an_empty_selection(spark):
    assert near_duplicates(common.documents(spark, SF).where("false"), 80).count() == 0


def test_toxicity_stage_counts_every_labelled_text(spark, tmp_path, monkeypatch):
    # More clean rows than any sample held; the stage's model has counted the words of them all.
    rows = [(i, "you idiot now" if i % 10 == 0 else "fine words here", int(i % 10 == 0)) for i in range(21_000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    table.select("doc_id", "toxic").write.parquet(f"{tmp_path}/labels.parquet")
    docs = table.select("doc_id", "text", *[F.lit(None).cast(t).alias(c) for c, t in (("lang", "string"), ("source", "string"), ("n_chars", "long"))])
    seen, score = [], cp.toxicity.score
    monkeypatch.setattr(cp.toxicity, "score", lambda d, model, *a: seen.append(model) or score(d, model, *a))
    kept = cp.drop_toxic(spark, docs, str(tmp_path))
    assert kept.count() == 18_900
    learned = sum(zlib.crc32(str(i).encode()) % 3 != 1 for i, _, toxic in rows if not toxic)
    assert learned > 10_000 and seen[0].chars.tri["^^f"] == learned
