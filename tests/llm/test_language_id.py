import itertools
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from starloom.llm import common, language_id as li, queries


def test_forward_backward_equals_brute_force():
    rng = np.random.default_rng(0)
    lengths = np.array([5, 3, 3, 1])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    e, t = rng.normal(size=(lengths.sum(), 3)) * 2, rng.normal(size=(3, 3))
    marginal, seen, log_z = li.forward_backward(e, starts, lengths, t, pairs=True)
    want, pairs, z_total = np.zeros_like(e), np.zeros((3, 3)), 0.0
    for a, n in zip(starts, lengths, strict=True):
        weights = {y: np.exp(sum(e[a + i, y[i]] for i in range(n)) + sum(t[y[i], y[i + 1]] for i in range(n - 1))) for y in itertools.product(range(3), repeat=int(n))}
        z = sum(weights.values())
        z_total += np.log(z)
        for y, w in weights.items():
            for i in range(n):
                want[a + i, y[i]] += w / z
            for i in range(n - 1):
                pairs[y[i], y[i + 1]] += w / z
    assert np.allclose(marginal, want) and np.allclose(seen, pairs) and np.isclose(log_z, z_total)


def test_features_of_words_do_not_depend_on_their_neighbours():
    words = ["a", "straße", "ñandú", "x" * 300, "a"]
    f, s = li.word_features(words, {"a"})
    ends = [*s[1:], len(f)]
    for w, a, b in zip(words, s, ends, strict=True):
        alone, _ = li.word_features([w], {"a"})
        assert sorted(f[a:b].tolist()) == sorted(alone.tolist())


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs = common.documents(spark, sf)
    got = queries.op6_language_id(spark, sf)
    assert got.count() == docs.count() and got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    both = got.join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL AND lang_pred != 'und'")
    r = both.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("right"), F.count("*").alias("n")).first()
    assert r["n"] > 1000 and r["right"] > 0.97


def test_code_switched_words(spark):
    sf = "/root/testdata/sf0.01"
    rows = {}
    for r in common.documents(spark, sf).where("lang in ('en', 'fr', 'de')").collect():
        rows.setdefault(r["lang"], []).append(li.text_words(r["text"]))
    rng = random.Random(0)
    model = li.fit([(lang, own[i : i + 20]) for lang, texts in rows.items() for own in texts[:60] for i in range(0, min(len(own), 60), 20)])
    right = total = 0
    for _ in range(20):
        a, b = rng.sample(["en", "fr", "de"], 2)
        x, y = rng.choice(rows[a][60:])[:30], rng.choice(rows[b][60:])[:30]
        p = li.Tagger(model).words([x + y])[0]
        got = [model.labels[i] for i in p.argmax(axis=1)]
        right += sum(g == w for g, w in zip(got, [a] * len(x) + [b] * len(y), strict=True))
        total += len(got)
    assert right > 0.9 * total


def test_defined_results(spark):
    schema = "doc_id long, text string, lang string, lang_pred string, score int, words int"
    rows = [(i, ("the cat and the dog " if i % 2 else "der hund und die katze ") * 8, "en" if i % 2 else "de", "x", 1, 1) for i in range(40)]
    rows += [(100, None, "en", None, None, None), (101, " 123 ...", None, None, None, None), (102, "", "de", None, None, None), (None, "und die katze", None, None, None, None),
             (103, "the dog " * 20_000, None, None, None, None), (103, "the dog " * 20_000, None, None, None, None), (104, "a" * 100_000, "en", None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    model = li.train(docs, F.lit(True))
    got = li.predict(docs, model, ["doc_id", "lang"]).collect()
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert len(got) == len(rows)
    assert by[100] == by[101] == by[102] == ("und", 0.0)
    assert by[None][0] == "de" and by[103][0] == "en" and by[0][0] == "de" and by[1][0] == "en"
    assert li.train(docs, F.lit(False)) is None
    assert {r["lang_pred"] for r in li.predict(docs, None, ["doc_id"]).collect()} == {"und"}
    assert li.predict(docs.limit(0), model, ["doc_id"]).count() == 0


def test_a_script_without_spaces_is_learned(spark):
    """Whole sentences are one token there; they are learned in pieces and predicted whole."""
    rng = random.Random(4)
    spaceless = ["".join(rng.choice("日本語文字山川水火木金土人大小中") for _ in range(200)) for _ in range(60)]
    spaced = [" ".join(rng.choice(["the", "cat", "sat", "on", "mat", "dog", "ran"]) for _ in range(50)) for _ in range(60)]
    rows = [(i, t, "ja") for i, t in enumerate(spaceless)] + [(100 + i, t, "en") for i, t in enumerate(spaced)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = li.train(docs, F.col("doc_id") % 2 == 0)
    assert model.labels == ["en", "ja"]
    got = {r["doc_id"]: r["lang_pred"] for r in li.predict(docs, model, ["doc_id"]).collect()}
    assert got == {i: lang for i, _, lang in rows}
    assert li.pieces("x" * 100) == ["x" * 40, "x" * 40, "x" * 20] and li.pieces("ab") == ["ab"]


def test_ties_go_to_the_first_label():
    model = li.Model(["x", "y"], np.zeros((li.BUCKETS, 2), np.float32), np.zeros((2, 2)), set())
    labels, score = li.Tagger(model)(pa.array(["aa bb", "", None, "12 !", "c"]))
    assert labels == ["x", "und", "und", "und", "x"] and np.allclose(score, [0.5, 0, 0, 0, 0.5])


def test_many_languages_share_the_sample(spark, monkeypatch):
    monkeypatch.setattr(li, "SAMPLE", 20)
    monkeypatch.setattr(li, "TOTAL", 40)
    rows = [(i, f"w{i % 10} v{i % 10} u{i % 10}", f"l{i % 10}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = li.train(docs, F.lit(True))
    assert model.labels == sorted({r[2] for r in rows})
    got = {r["doc_id"]: r["lang_pred"] for r in li.predict(docs, model, ["doc_id"]).collect()}
    assert sum(got[i] == lang for i, _, lang in rows) == 300
