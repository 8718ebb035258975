import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

from starloom.llm import common, queries
from starloom.llm import conversation_repair as repair

COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
TEXT = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    """Conversation -> rows after damage, by the contract."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        own = out[conv]
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        own += [(turn, role, text)] * (2 if fault == 3 else 1)
    for own in out.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    return out


def cheapest(items):
    """(cost, audit) by dynamic programming from the end: all edits of all rows in all four states."""
    step = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
    turn = [2, 2, 3, 2]

    def with_inserts(best):
        for _ in range(6):
            for q in range(4):
                if best[turn[q]] is not None:
                    c, a = best[turn[q]]
                    best[q] = min(x for x in (best[q], (c + 5, "I" + a)) if x is not None)
        return best

    best = with_inserts([(0, ""), None, None, (0, "")])
    for initial, forced, cut in reversed(items):
        new = [None] * 4
        for q in range(4):
            ways = []
            if best[q] is not None:
                ways.append((best[q][0] + 2, "D" + best[q][1]))
            if not forced:
                more = 5 if cut else 0
                p = step[q].get(initial)
                if p is not None and best[p] is not None:
                    ways.append((best[p][0] + more, "K" + best[p][1]))
                if best[turn[q]] is not None:
                    ways.append((best[turn[q]][0] + 1 + more, "R" + best[turn[q]][1]))
            new[q] = min(ways) if ways else None
        best = with_inserts(new)
    return best[0]


def expected(rows):
    out = {}
    for conv, own in damaged(rows).items():
        seen, items, faults = set(), [], Counter()
        for _, role, text in own:
            body = TEXT.findall(text)
            blank = not body
            duplicate = not blank and (role, text) in seen
            cut = not blank and not duplicate and body[-1] not in ".!?"
            faults.update(blank=blank, duplicate=duplicate, truncated=cut)
            seen.add((role, text))
            items.append((role[:1], blank or duplicate, cut))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(items, items[1:]))
        cost, audit = cheapest(items)
        lines, state, left = [], "", list(own)
        for edit in audit:
            role, text = (None, "") if edit == "I" else left.pop(0)[1:]
            if edit == "D":
                continue
            if edit in "IR":
                role = "assistant" if state == "u" else "user"
            state = role[:1]
            lines.append((role, text))
        assert not left and re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in lines))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest), lines
    return out


def check(spark, rows, block=repair.BLOCK, schema="conv_id long, turn long, role string, text string"):
    docs = spark.createDataFrame(rows, schema)
    faulty = repair.damage(docs)
    want = expected([r[:4] for r in rows])
    got = repair.repair(faulty, block).collect()
    assert {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in got} == {c: w for c, (w, _) in want.items()}
    assert len(got) == len(want)
    return faulty, want


def test_query_as_by_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in common.table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    want = expected(rows)
    got = queries.op12_conversation_repair(spark, sf).collect()
    assert {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in got} == {c: w for c, (w, _) in want.items()}


def random_items(rnd, n):
    return [(rnd.choice(["s", "u", "a", "u", "a", "t", ""]), rnd.random() < 0.15, rnd.random() < 0.2) for _ in range(n)]


def test_search_as_by_dynamic_programming():
    rnd = random.Random(5)
    for _ in range(3000):
        items = random_items(rnd, rnd.randint(0, 9))
        own = [1 if forced else (initial, cut) for initial, forced, cut in items]
        assert repair.search(own) == cheapest(items), items


def test_tables_of_parts_multiply_to_the_whole():
    rnd = random.Random(6)
    for _ in range(200):
        items = random_items(rnd, rnd.randint(2, 14))
        own = [1 if forced else (initial, cut) for initial, forced, cut in items]
        k = rnd.randint(0, len(own))
        both = repair.joined(repair.table(own[:k]), repair.table(own[k:]))
        assert both == repair.table(own)
        assert min(both[0, q] for q in repair.FINAL if (0, q) in both) == cheapest(items)


def test_runs_of_forced_deletes_are_one_edge():
    items = [("u", False, False), *[("u", True, False)] * 5, ("u", False, False)]
    assert repair.search([("u", False), 5, ("u", False)]) == cheapest(items)


def test_random_conversations_in_blocks(spark):
    rnd = random.Random(7)
    texts = ["Fine.", "Cut off", "", " \n", "Yes!", "No? ", "Twice.", "a", None]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    rows = [
        (c if c else None, t if rnd.random() < 0.95 else None, rnd.choice(roles), f"{rnd.choice(texts)}{rnd.randint(0, 9)}" if rnd.random() < 0.6 else rnd.choice(texts))
        for c in range(60)
        for t in range(rnd.randint(0, 9))
    ]
    faulty, want = check(spark, rows)
    # The repaired rows themselves.
    got = defaultdict(list)
    for r in repair.repaired_rows(faulty, repair.audits(faulty)).orderBy("conv_id", "place").collect():
        got[r["conv_id"]].append((r["role"], r["text"]))
    assert dict(got) == {c: lines for c, (_, lines) in want.items() if lines}


def test_long_conversation_is_cut_and_joined(spark):
    rnd = random.Random(8)
    hot = [(7, t // 2, rnd.choice(["user", "assistant"]), rnd.choice(["Same.", f"Line {t}.", f"Line {t}", " "])) for t in range(900)]
    other = [(c, t, "user" if t % 2 == 0 else "assistant", f"Text {t}.") for c in range(40) for t in range(4) if c != 7]
    check(spark, hot + other, block=16)


def test_defined_results(spark):
    schema = "conv_id long, turn long, role string, text string, cost string, present_ string, audit int, key binary"
    more = ("x", "y", 3, b"k")
    rows = [
        (1, None, "user", "Null turn.", *more), (1, 3, None, "Null role.", *more), (1, 3, "user", None, *more), (1, 9, "user", "Ends well!", *more),
        (None, 1, "user", "No conversation.", *more), (None, 2, "assistant", "No conversation.", *more),
        (2, 5, "system", "Alone.", *more), (3, 1, "user", "Tie.", *more), (3, 1, "assistant", "Tie.", *more), (3, 1, "user", "Tie.", *more),
        (4, 1, "user", "long " * 400_000 + ".", *more), (4, 2, "assistant", "é" * 1_000_000, *more), (5, -(2**62), "user", "a.", *more), (5, 2**62, "assistant", "b.", *more),
    ]
    check(spark, rows, schema=schema)
    check(spark, [], schema=schema)
    # A conversation of which every row is dropped stays, with nothing in it.
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    _, want = check(spark, [(gone, 0, "user", "Gone.")])
    assert want[gone][0] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
