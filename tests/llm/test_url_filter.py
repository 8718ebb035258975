import itertools
import math
import re
from collections import Counter

from starloom.llm import common, queries, url_filter as uf


def test_split_and_rules():
    cases = {
        None: ("", "", None), "no scheme/x": ("", "", None), "https://A.Example.COM/en/1?x=/q#y": ("a.example.com", "/en/1", "example.com/en/"),
        "http://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/"), "http://b.www.example.com/en/x": ("b.www.example.com", "/en/x", "www.example.com/en/"),
        "http://x.net/es/1": ("x.net", "/es/1", "net/es/"), "http://x.net/de/1": ("x.net", "/de/1", None), "http://a.com": ("a.com", "", None),
        "http://a.com?b=/": ("a.com", "", None), "http://a.com#/": ("a.com", "", None), "http://a.com/": ("a.com", "/", "com/"), "http://notcom/": ("notcom", "/", None),
        "x://net/fr/": ("net", "/fr/", "net/fr/"), "http://É.com/É": ("É.com", "/É", "com/"), "": ("", "", None), "://": ("", "", None),
    }
    for url, want in cases.items():
        host, path = uf.split_url(url)
        rule = uf.rule_for(host, path)
        assert (host, path, rule and rule.name) == want, url


def test_viterbi_equals_brute_force():
    counts = {"cheap": 50, "pills": 30, "pill": 10, "s": 5, "chea": 1, "online": 100, "on": 200, "line": 90, "shop": 40}
    total = sum(counts.values())

    def score(words):
        return sum(math.log((counts[w] + 0.1) / (total + 1)) if w in counts else math.log(uf._UNKNOWN / (total + 1)) - 2.3 * len(w) for w in words)

    for label in ["cheappills", "onlineshop", "shoponline", "pillx"]:
        cuts = range(1, len(label))
        every = [[label[a:b] for a, b in itertools.pairwise([0, *c, len(label)])] for n in range(len(label)) for c in itertools.combinations(cuts, n)]
        assert score(uf.segment(label, counts, total)) >= max(map(score, every)) - 1e-9
    assert uf.segment("cheappills", counts, total) == ["cheap", "pills"] and uf.segment("", counts, total) == []
    assert "".join(uf.segment("q" * 5000, counts, total)) == "q" * 5000


def brute_scores(rows, verdicts=uf.RULES):
    """spam_score of every (host, path) by multinomial naive Bayes over whole lists, with plain counters.
    ``rows``: (url, html)."""
    words = Counter()
    for _, html in rows:
        text = re.sub(r"<(script|style)\b.*?</\1>|<[^>]*>", " ", html or "", flags=re.DOTALL | re.IGNORECASE).lower()
        words.update(re.findall(r"[^\W\d_]+", text))
    total = sum(words.values())
    for w in uf.SPAM_WORDS:
        words[w] += 1 + total // 10_000
    split = {}
    docs = []
    for url, _ in rows:
        host, path = uf.split_url(url)
        tokens = []
        for label in uf.host_labels(host):
            if label not in split:
                split[label] = uf.segment(label, words, total)
            tokens += split[label]
        docs.append((host, path, tokens + uf.path_tokens(path)))
    counts, n = {True: Counter(), False: Counter()}, Counter()
    for _, _, tokens in docs:
        block = bool(set(tokens) & set(uf.SPAM_WORDS))
        counts[block].update(tokens)
        n[block] += 1
    v = len(set(counts[True]) | set(counts[False]))
    size = {c: sum(counts[c].values()) for c in counts}
    prior = math.log((n[True] + 1) / (n[False] + 2))

    def odds(t):
        return math.log((counts[True][t] + 1) / (size[True] + v + 1)) - math.log((counts[False][t] + 1) / (size[False] + v + 1))

    return {(h, p): prior + sum(map(odds, tokens)) for h, p, tokens in docs}, {(h, p): set(t) for h, p, t in docs}


def check_query(spark, pages, rows, learned=None):
    want, tokens = brute_scores([(r["url"], r["html"]) for r in pages] if learned is None else [(r[1], r[2]) for r in learned])
    urls = {r["page_id"]: r["url"] for r in pages}
    assert sorted({r["page_id"] for r in rows}) == sorted(urls)
    differs = 0
    for r in rows:
        host, path = uf.split_url(urls[r["page_id"]])
        rule = uf.rule_for(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule.name)
        assert abs(r["spam_score"] - want[host, path]) < 1e-9 * max(1, abs(want[host, path])), (host, path)
        assert r["verdict"] == (rule.verdict if rule else "block" if want[host, path] > 0 else "allow")
        differs += (want[host, path] > 0) != bool(tokens[host, path] & set(uf.SPAM_WORDS))
    return differs


def test_every_score_as_by_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    pages = common.table(spark, sf, "pages").collect()
    check_query(spark, pages, queries.op5_url_filters(spark, sf).collect())


def test_words_count_as_often_as_they_occur(spark, monkeypatch):
    monkeypatch.setattr(uf, "HOT_SHARE", 8)  # com is hot, most are not
    rows = [(i, f"http://shop{i}.com/news/news/news/{'free/' if i % 7 == 0 else ''}x", "<p>news shop x free</p>") for i in range(60)]
    rows += [(100 + i, f"http://win.win.casino{i % 3}.org/free/free/slots", None) for i in range(20)]
    rows += [(200, "http://news.org/news/news/news/news/news/news/free", None), (201, "http://" + "a" * 40 + "longword" * 3 + ".org/", "longword" * 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    # One spam word among many innocent ones does not decide.
    assert check_query(spark, pages.collect(), uf.judge(pages, ["page_id"]).collect()) > 0
    by = {r["page_id"]: r["verdict"] for r in uf.judge(pages, ["page_id"]).collect()}
    assert by[200] == "allow" and by[103] == "block"


def test_defined_results(spark):
    schema = "page_id long, url string, html string, host string, tokens int, label string"
    rows = [(1, None, None, None, None, None), (2, "http://cheappills.org/x", "<p>cheap pills online</p>", "h", 1, "x"), (2, "http://cheappills.org/x", None, None, None, None),
            (None, "http://a.com/", "", None, None, None), (5, "https://news.org/" + "a/" * 20_000, "<script>x", None, None, None)]
    rows += [(100 + i, f"http://site{i}.org/page", "<b>site page news</b>", None, None, None) for i in range(30)]
    got = uf.judge(spark.createDataFrame(rows, schema), ["page_id"]).collect()
    by = {r["page_id"]: r for r in got}
    assert len(got) == len(rows) and (by[1]["host"], by[1]["path"], by[1]["rule"], by[1]["verdict"]) == ("", "", None, "allow")
    assert by[2]["verdict"] == "block" and by[5]["verdict"] == "allow" and by[None]["rule"] == "com/"
    check_query(spark, [r for r in spark.createDataFrame(rows, schema).collect() if r["page_id"]], [r for r in got if r["page_id"]], rows)
    assert uf.judge(spark.createDataFrame([], schema), ["page_id"]).count() == 0
