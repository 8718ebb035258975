from collections import Counter

from pyspark.sql import functions as F

from starloom.llm import common, deobfuscate, queries, toxicity

WORDS = "the idiot worthless clown pathetic there other that scum moron trash loser stupid this is a kind letter bottle".split()


def chars(extra=()):
    counts = Counter()
    for w in [*WORDS * 20, *extra]:
        counts.update(deobfuscate.CharModel.grams(w))
    return deobfuscate.CharModel(counts)


def test_decode_restores_disguised_words():
    m = chars()
    for noisy, plain in [("1d10t", "idiot"), ("w0rthl3ss", "worthless"), ("cl0wn", "clown"), ("p@th3tic", "pathetic"),
                         ("$cum", "scum"), ("iiiidiot", "idiot"), ("mooooron", "moron"), ("tr4$h", "trash"), ("l.o$er", "loser")]:
        assert deobfuscate.decode(noisy, m) == plain, noisy
    assert deobfuscate.joined("you i d i o t here") == "you idiot here"
    assert deobfuscate.joined("i.d.i.o.t!") == "idiot!"
    assert deobfuscate.joined("a b") == "a b"


def test_plain_words_stay_and_long_tokens_decode():
    r = deobfuscate.Restorer(chars())
    assert r("Hello, Bottle? (There)") == {"hello", "bottle", "there"}
    assert r(None) == r("") == r(" ... 123 ") == set()
    assert r("a1" * 40_000)  # linear in its length


def test_viterbi_equals_brute_force_over_all_paths():
    import itertools

    m = chars()
    for noisy in ["1d10t", "5c|m", "aaa1e", "tr4$h"]:
        best = max(
            itertools.product(*deobfuscate._segments(noisy)),
            key=lambda p: sum(c for _, c in p) + sum(m.logp(g) for g in m.grams("".join(x for x, _ in p))),
        )
        assert deobfuscate.decode(noisy, m) == "".join(x for x, _ in best)


def test_gaps_are_part_of_the_lattice():
    import itertools

    m = chars(["a", "is", "it"] * 30)
    r = deobfuscate.Restorer(m)
    for noisy, plain in [("i d iot", "idiot"), ("tr a s h", "trash"), ("m o r0 n", "moron"), ("c.l.0.wn", "clown"), ("i d i o t", "idiot")]:
        assert plain in r(f"you {noisy} there"), noisy
    assert deobfuscate.decode_spaced(["it", "is", "a"], m) == ["it", "is", "a"]  # words stay words
    assert r("a b") == {"a", "b"} and "ab" not in r("it is a b, is it")

    def score(path, parts):
        words = "".join(x for x, _ in path).split("\x00")
        return sum(c for _, c in path) + sum(m.logp(g) for w in words for g in m.grams(w))

    for parts in (["i", "d", "i"], ["tr", "4", "$h"], ["a", "is", "it"], ["cl", "o", "w"]):
        lattice = deobfuscate._segments(parts[0])
        for p in parts[1:]:
            lattice = [*lattice, [("", deobfuscate.GAP), ("\x00", 0.0)], *deobfuscate._segments(p)]
        best = max(itertools.product(*lattice), key=lambda path: score(path, parts))
        assert deobfuscate.decode_spaced(parts, m) == [w for w in "".join(x for x, _ in best).split("\x00") if w]
    assert r("a b " * 30_000)  # linear in its length


def test_very_long_texts_and_labels_that_disagree(spark):
    docs = spark.createDataFrame([(i, ("you idiot moron scum " if i % 2 else "a kind letter ") * (5 + i % 7)) for i in range(60)], "doc_id long, text string")
    labels = [(i, i % 2) for i in range(60)] + [(1, 0), (None, 1), (5, None)]
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
    long = spark.createDataFrame([(1, "a kind letter " * 50_000), (2, "a kind letter " * 50_000 + "you idiot moron scum")], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(long, model, ["doc_id"]).collect()}
    assert 0 <= got[1] < got[2] <= 1


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op9_toxicity(spark, sf)
    labels = common.table(spark, sf, "labels").where("toxic IS NOT NULL")
    assert rows.count() == common.documents(spark, sf).count()
    assert rows.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    got = rows.where("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in got}
    right, false = n.get((1, 1), 0) / max(1, n.get((1, 1), 0) + n.get((1, 0), 0)), n.get((0, 1), 0) / max(1, n.get((0, 1), 0) + n.get((0, 0), 0))
    assert right > 0.9 and false < 0.01, n


def test_defined_results(spark):
    schema = "doc_id long, text string, score string, toxic string, top int"
    rows = [(i, ("you idiot " if i % 3 == 0 else "fine words ") + f"number n{i}", None, "x", 1) for i in range(120)]
    rows += [(500, None, None, None, None), (501, "", None, None, None), (None, "you 1d10t", None, None, None), (502, "you iiidiot", None, None, None), (502, "you iiidiot", None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 1) for i in range(120)] + [(None, 1, 0), (7, None, None), (500, 5, 1)], "doc_id long, toxic int, quality int")
    model = toxicity.train(docs, labels, F.lit(True))
    got = toxicity.score(docs, model, ["doc_id", "toxic"]).collect()
    by = {r["doc_id"]: r["score"] for r in got}
    assert len(got) == len(rows) and by[0] > 0.7 > by[1] and by[500] == by[501] < 0.5
    assert by[None] > 0.7 and by[502] > 0.7
    none = toxicity.train(docs, labels.limit(0), F.lit(True))
    assert {r["score"] < 1e-9 for r in toxicity.score(docs, none, ["doc_id"]).collect()} == {True}
    assert toxicity.score(docs.limit(0), model, ["doc_id"]).count() == 0


def test_every_label_is_learned_from(spark):
    # 20,000 clean documents, more than any sample held: a word that only a few of the toxic ones hold is learned too.
    rows = [(i, "rareslur now" if i % 2500 == 0 else "you idiot now" if i % 10 == 0 else f"fine words n{i % 50}", int(i % 10 == 0)) for i in range(24_000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    docs = table.select("doc_id", "text")
    assert toxicity.labelled_texts(docs, table.select("doc_id", "toxic"), F.lit(True)).count() == len(rows)
    # Labels without a document, documents without a label and null ids are left out; repeated rows stay.
    few = table.where("doc_id < 100").select("doc_id", "toxic").unionByName(spark.createDataFrame([(None, 1), (10**9, 1)], "doc_id long, toxic int"))
    twice = docs.where("doc_id < 200").unionByName(docs.where("doc_id = 5")).unionByName(spark.createDataFrame([(None, "x")], "doc_id long, text string"))
    assert toxicity.labelled_texts(twice, few, F.lit(True)).count() == 101
    model = toxicity.train(docs, table.select("doc_id", "toxic"), F.lit(True))
    assert model.chars.tri["^^f"] == 21_600 and sum(model.chars.tri[g] for g in ("^^r", "^^y")) == 2400
    assert "=rareslur" in model.weight


def test_shorter_grams_are_counted_over_all_trigrams(spark, monkeypatch):
    rows = [(i, f"{'good' if i % 4 else 'idiot'} {chr(97 + i % 26) * 2}{chr(97 + i * 7 % 26)}", int(i % 4 == 0)) for i in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    train = lambda: toxicity.train(table.select("doc_id", "text"), table.select("doc_id", "toxic"), F.lit(True)).chars
    whole = train()
    monkeypatch.setattr(toxicity, "GRAMS", 40)
    few = train()
    assert len(whole.tri) > len(few.tri) == 40 and set(few.tri.items()) < set(whole.tri.items())
    # Single signs are as many as in all trigrams; of bigrams the most frequent, each with its whole count.
    assert few.one == whole.one and few.total == whole.total
    assert len(few.bi) == 40 and set(few.bi.items()) < set(whole.bi.items())
