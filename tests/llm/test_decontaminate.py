import re

from starloom.llm import common, decontaminate, queries

SCHEMA = "doc_id long, text string, lang string, item long, h string, raw int"
B = "item_id long, text string, size int"
ITEMS = [
    (1, "A farmer called Alice has 12 apples and gives 3 apples to Bob before he walks 5 km home with Alice.", 1),
    (2, "to be or not to be", 1),
    (3, None, None),
    (None, "", 2),
]


def found(spark, texts, items=ITEMS):
    docs = spark.createDataFrame([(i, t, "en", 1, "x", 2) for i, t in texts], SCHEMA)
    got = decontaminate.contaminated(docs, spark.createDataFrame(items, B)).collect()
    return sorted((r["doc_id"] or 0, r["item_id"] or 0, r["n_slots"]) for r in got)


def test_templates_catch_other_numbers_names_and_units(spark):
    texts = [
        (1, "Noise before. " + ITEMS[0][1] + " and noise after it"),
        (2, "a farmer called Carol has 77 apples, and gives 4 apples to Dave before he walks 9 miles home with Carol"),
        # the slots contradict: two names for Alice, one number for two
        (3, "a farmer called Carol has 77 apples, and gives 4 apples to Dave before he walks 9 miles home with Erwin"),
        (4, "a farmer called Carol has 77 apples, and gives 77 apples to Dave before he walks 9 miles home with Carol"),
        (5, "a farmer has apples"),
        (6, None), (7, ""), (8, "1 2 3 4 5 6 7 8 9 " * 500), (9, "to be or not to be"),
        (10, "x " * 60_000 + ITEMS[0][1]),
        (None, "so " + ITEMS[0][1]), (1, "Noise before. " + ITEMS[0][1] + " and noise after it"),
    ]
    assert [(d, i) for d, i, _ in found(spark, texts)] == [(0, 1), (1, 1), (2, 1), (9, 2), (10, 1)]


LONG = (
    "A cook called Alice pours 12 litres of water into a pot and stirs it slowly while her friend Bob cuts carrots, onions and "
    "beans for the soup that they sell at noon to 40 guests before he adds 12 litres more and serves it"
)


def test_a_contradicting_slot_does_not_void_a_long_copy(spark):
    texts = [
        (1, LONG.replace("adds 12", "adds 13")),
        (2, "so " + LONG.replace("12", "77").replace("Alice", "Carol").replace("adds 77", "adds 13")),
        # a rewritten gap hits one of two mentions
        (3, ITEMS[0][1].replace("he walks 5 km home with Alice", "they all go by bus to see Erwin") + " " + ITEMS[0][1].split(" before")[0]),
        (4, LONG.replace("and stirs it slowly while her friend Bob", "then mixes everything as long as Zoe").replace("adds 12", "adds 13")),
        (5, "a cook called Carol pours 1 litres"),
    ]
    assert [(d, i) for d, i, _ in found(spark, texts, [*ITEMS, (7, LONG, 1)])] == [(1, 7), (2, 7), (3, 1), (4, 7)]


def test_copies_of_items_of_numbers_or_names_are_found(spark):
    items = [
        (1, "What is 12 + 7 * 31 - 8 / 2 + 45 * 6 - 19 + 3 * 77 - 5?", 1),
        (2, "we met with Anna, Boris, Clara, David, Emil, Frida, Gustav, Hanna, Igor and Jana", 1),
        (3, "count 1 2 3 then say 4 5 6 7 words 8 9 10 11 and 12 13 14 now 15 16 17 go", 1),
    ]
    texts = [(i, f"Noise before: {t} and noise after it") for i, t, _ in items]
    texts += [(4, "What is 13 + 8 * 32 - 9 / 3 + 46 * 7 - 20 + 4 * 78 - 6?"), (5, "1 2 3 4 5 6 7 8 9 " * 50)]
    assert [(d, i) for d, i, _ in found(spark, texts, items)] == [(1, 1), (2, 2), (3, 3)]


def test_names_that_open_a_sentence_other_case_and_numbers_with_separators(spark):
    items = [
        (1, "Alice has 3 apples. Bob has 5 pears. Carol buys 4 plums from them. How many fruits does Bob have left?", 1),
        (2, ITEMS[0][1], 1),
        (3, "a ticket costs 2.50 dollars and a meal costs 1,200 dollars so how much do both of them cost", 1),
        (4, "the old farmer walks slowly along the river and sells fresh bread to his friends", 1),
    ]
    renamed = items[0][1].replace("Alice", "Dan").replace("Bob", "Erin").replace("Carol", "Fred")
    texts = [
        (1, renamed),
        (2, 'She said: "' + renamed.replace(". ", ".\n") + '"'),
        (3, ITEMS[0][1].lower()),
        (4, ITEMS[0][1].upper()),
        (5, items[2][1].replace("2.50", "3").replace("1,200", "900")),
        (6, items[3][1].title()),
        (7, "Dan Has Many Apples. Erin Has Some Pears."),
    ]
    assert [(d, i) for d, i, _ in found(spark, texts, items)] == [(1, 1), (2, 1), (3, 2), (4, 2), (5, 3), (6, 4)]


def test_a_name_of_several_words_is_one_name(spark):
    item = "Alice has 3 apples and 5 pears. Bob gives her 4 plums from his old garden. How many fruits does Alice have left?"
    two = item.replace("Alice", "Mary Ann").replace("Bob", "Juan Carlos Lee").replace("3 apples", "7 apples").replace("4 plums", "9 plums")
    texts = [
        (1, two),
        (2, "They all live in Paris. " + two),  # names on either side of a full stop are two
        (3, "Mary Ann has apples. Bob gives plums."),
    ]
    assert [(d, i) for d, i, _ in found(spark, texts, [(1, item, 1)])] == [(1, 1), (2, 1)]
    words = decontaminate._tokens(spark.createDataFrame([(texts[1][1][:60],)], "text string"), "text").first()
    assert words["wide_raw"][4:7] == ["paris", "mary\x04ann", "has"] and words["raw"][4:8] == ["paris", "mary", "ann", "has"]
    assert len(words["raw"]) == len(words["tpl"]) and len(words["wide_raw"]) == len(words["wide_tpl"])


def test_text_with_the_marks_of_cleaned_texts(spark):
    """Control characters in a text are white space, as any sign that is no letter or digit."""
    texts = [(1, "\x01so " + ITEMS[0][1].replace(" has ", "\x02has\x03").replace(" before ", "\x04before ")), (2, "\x01\x02\x03\x04" * 50)]
    assert [(d, i) for d, i, _ in found(spark, texts)] == [(1, 1)]


def test_window_hashes_are_those_of_equal_token_runs(spark):
    words = ["a", "b", "a", "a", "c", "b", "a", "b", "a", "a", "c"]
    df = spark.createDataFrame([(1, words), (2, words[5:]), (3, []), (4, ["a"])], "id long, t array<string>")
    df = df.withColumn("h", decontaminate._token_hashes("t"))
    for size in (1, 2, 3, 5):
        rows = decontaminate._listed(df, "h", size, "id").collect()
        seen = {}
        for r in rows:
            own = tuple((words if r["id"] == 1 else words[5:] if r["id"] == 2 else ["a"])[r["ipos"] : r["ipos"] + size])
            assert len(own) == size and seen.setdefault(own, r["h"]) == r["h"]
        assert len(set(seen.values())) == len(seen) and len(rows) == sum(max(0, n - size + 1) for n in (11, 6, 0, 1))


def test_clean_keeps_the_rest_and_all_columns(spark):
    docs = spark.createDataFrame([(1, "so " + ITEMS[0][1], "en", 1, "x", 2), (2, "fine", None, None, None, None), (None, None, None, None, None, None)], SCHEMA)
    kept = decontaminate.clean(docs, spark.createDataFrame(ITEMS, B))
    assert kept.columns == docs.columns and sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 2]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, ITEMS[0][1], "en", 1, "x", 2)], SCHEMA)
    assert decontaminate.contaminated(docs, spark.createDataFrame([], B)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), spark.createDataFrame(ITEMS, B)).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, ITEMS[0][1], "en", 1, "x", 2)], SCHEMA)
    plan = decontaminate.contaminated(docs, spark.createDataFrame(ITEMS, B))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_whole_items_in_documents_are_found_and_little_else(spark):
    """Against a plain search for runs of 13 (or all but two) words on sf0.1."""
    sf = "/root/testdata/sf0.1"
    tok = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    items = {r["item_id"]: tok(r["text"]) for r in common.table(spark, sf, "benchmark").collect()}
    index = {}
    for i, w in items.items():
        n = min(13, max(len(w) - 2, 1))
        for k in range(len(w) - n + 1):
            index.setdefault((n, tuple(w[k : k + n])), set()).add(i)
    sizes = {n for n, _ in index}
    want = set()
    for r in common.documents(spark, sf).collect():
        w = tok(r["text"])
        for n in sizes:
            for k in range(len(w) - n + 1):
                for i in index.get((n, tuple(w[k : k + n])), ()):
                    want.add((r["doc_id"], i))
    got = {(r["doc_id"], r["item_id"]) for r in queries.op10_decontamination(spark, sf).collect()}
    assert len(want) > 200 and want <= got and len(got - want) <= 0.01 * len(want)


def test_planted_copies_of_real_items_with_other_slots_are_all_found(spark):
    """Items of sf0.1 given numbers and names, then planted in real documents with all of them replaced."""
    sf = "/root/testdata/sf0.1"
    rows = common.table(spark, sf, "benchmark").orderBy("item_id").collect()
    items, copies = [], []
    for r in rows:
        w = (r["text"] or "").split()
        if len(w) < 20:
            continue
        for values, out in ((("Alice", "17", "40", "Bob"), items), (("Mary Ann" if r["item_id"] % 2 else "Zoe", "23", "2.50", "Yusuf"), copies)):
            v = list(w)
            for place, value in zip((4, 8, 12, 15), values, strict=True):
                v[place] = value if place != 12 else value + " km"
                v[place - 1] = v[place - 1].rstrip(".!?:") .lower()
            out.append((r["item_id"], " ".join(v)))
    texts = [r["text"] for r in common.documents(spark, sf).orderBy("doc_id").limit(len(copies)).collect()]
    docs = spark.createDataFrame([(i, f"{t} {c} {t}") for (i, c), t in zip(copies, texts, strict=True)], "doc_id long, text string")
    got = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(copies) > 20 and {i for i, _ in copies} <= {r["doc_id"] for r in got if r["doc_id"] == r["item_id"]}
