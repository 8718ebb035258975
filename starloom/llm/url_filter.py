"""URL filters: rules first, then segmented host words under multinomial naive Bayes.

Host labels that run words together are split by a unigram Viterbi search, whose word counts come
from the pages' own visible text; only counts of the labels' substrings are joined in, so nothing
grows on the driver. Multinomial naive Bayes then scores the words of host and path, each as often as it
occurs. Its examples are weak labels: urls among whose words is one of a small lexicon of spam words
are block, all others allow, so words that keep such company count too and a single such word among
many innocent ones need not decide.

Defined results: a null url or one without ``://`` has empty host and path and is scored by the
prior alone (allow); repeated rows get equal verdicts and count as often as they occur; ties of rules go
to the one given first; urls, labels and texts are read whole, whatever their length (a word within a
label has at most ``LONGEST`` letters, as a host label has); an empty table gives no rows. Columns besides
``keep``, url and html are ignored, whatever their names; ``keep`` must not name the result's columns.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import materialize


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

# Words that mark examples of block.
SPAM_WORDS = tuple(
    "adult bet betting bonus casino cheap click crypto deal deals farm free gambling loan loans lottery lucky "
    "mega pharma pharmacy pill pills porn poker prize promo replica seo sex slots spam viagra win winner xxx".split()
)

LONGEST = 63  # octets that a host label may have, so no word in it is longer
_UNKNOWN = 10.0
HOT_SHARE = 256


def split_url(url: str | None) -> tuple[str, str]:
    """(host in lower-case A-Z, path)."""
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url[at + 3 :], re.DOTALL)
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1])
    return host, m[2]


def rule_for(host: str, path: str, rules: tuple[Rule, ...] = RULES) -> Rule | None:
    """The longest rule whose host is the url's or a parent of it and whose path starts the url's."""
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.name), default=None)


def segment(label: str, counts: dict[str, int], total: int) -> list[str]:
    """The likeliest split into words under unigram counts; unknown words cost ever more with their
    length. Linear in the label's length."""
    best = [(0.0, 0)]
    for end in range(1, len(label) + 1):
        options = []
        for start in range(max(0, end - LONGEST), end):
            w = label[start:end]
            n = counts.get(w, 0)
            score = math.log((n + 0.1) / (total + 1)) if n else math.log(_UNKNOWN / (total + 1)) - 2.3 * len(w)
            options.append((best[start][0] + score, -start))
        s, start = max(options)
        best.append((s, -start))
    out, at = [], len(label)
    while at:
        out.append(label[best[at][1] : at])
        at = best[at][1]
    # Neighbouring single letters are one unknown word.
    words: list[str] = []
    for w in reversed(out):
        if words and len(w) == 1 and not counts.get(w) and not counts.get(words[-1]):
            words[-1] += w
        else:
            words.append(w)
    return words


def path_tokens(path: str) -> list[str]:
    """Words of a path; digits become one token."""
    return [("/#" if t.isdigit() else f"/{t}") for t in re.findall(r"[^\W_]+", path.lower())]


def host_labels(host: str) -> list[str]:
    return [x for x in re.split(r"[^a-z0-9\u0080-\U0010ffff]+", host) if x]


_PARTS = "host string, path string, rule string, labels array<string>, tokens array<string>"


def _parse(rules: tuple[Rule, ...], keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = pa.list_(pa.string())
        for b in batches:
            split = [split_url(u) for u in b.column("__url").to_pylist()]
            found = [rule_for(h, p, rules) for h, p in split]
            yield pa.RecordBatch.from_arrays(
                [
                    *(b.column(k) for k in keep),
                    pa.array([h for h, _ in split], pa.string()),
                    pa.array([p for _, p in split], pa.string()),
                    pa.array([r and r.name for r in found], pa.string()),
                    pa.array([host_labels(h) for h, _ in split], strings),
                    pa.array([path_tokens(p) for _, p in split], strings),
                ],
                [*keep, "host", "path", "rule", "labels", "tokens"],
            )

    return run


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the words of visible text, per batch."""
    from collections import Counter

    for b in batches:
        seen: Counter[str] = Counter()
        for html in b.column("html").to_pylist():
            text = re.sub(r"<(script|style)\b.*?</\1>|<[^>]*>", " ", html or "", flags=re.DOTALL | re.IGNORECASE).lower()
            seen.update(w for w in re.findall(r"[^\W\d_]+", text) if len(w) <= LONGEST)
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})


def _substrings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for label in b.column("label").to_pylist():
            parts = sorted({label[i:j] for i in range(len(label)) for j in range(i + 1, min(len(label), i + LONGEST) + 1)})
            for at in range(0, len(parts), 10_000):
                own = parts[at : at + 10_000]
                yield pa.RecordBatch.from_pydict({"label": pa.array([label] * len(own)), "word": pa.array(own)})


def _segment(total: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for label, found in zip(b.column("label").to_pylist(), b.column("known").to_pylist(), strict=True):
                counts = {x["word"]: x["n"] for x in found or ()}
                out.append(segment(label, counts, total))
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(out, pa.list_(pa.string()))], ["label", "words"])

    return run


def segmented_labels(labels: DataFrame, pages: DataFrame) -> DataFrame:
    """Distinct (label, words)."""
    counts = pages.select(F.col("html").cast("string").alias("html")).mapInArrow(_word_counts, "word string, n long")
    counts = materialize(counts.groupBy("word").agg(F.sum("n").alias("n")), "url-words")
    total = int(counts.agg(F.sum("n")).first()[0] or 0)
    lexicon = labels.sparkSession.createDataFrame([(w, 1 + total // 10_000) for w in SPAM_WORDS], "word string, n long")
    counts = counts.unionByName(lexicon).groupBy("word").agg(F.sum("n").alias("n"))
    distinct = labels.select("label").distinct()
    known = distinct.mapInArrow(_substrings, "label string, word string").join(counts, "word")
    known = known.groupBy("label").agg(F.collect_list(F.struct("word", "n")).alias("known"))  # a label's own substrings
    return distinct.join(known, "label", "left").mapInArrow(_segment(total), "label string, words array<string>")


def judge(pages: DataFrame, keep: list[str], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``keep`` columns, host, path, rule, verdict, spam_score (the log odds of block)."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema)
    urls = pages.select(*keep, F.col("url").cast("string").alias("__url")).mapInArrow(_parse(rules, keep), f"{fields}, {_PARTS}")
    urls = materialize(urls, "urls")
    hosts = urls.select("host", "labels").distinct()
    words = segmented_labels(hosts.select(F.explode("labels").alias("label")), pages)
    # A host's own labels, as often as they stand in it.
    host_words = (
        hosts.select("host", F.explode("labels").alias("label"))
        .join(words, "label")
        .groupBy("host")
        .agg(F.flatten(F.collect_list("words")).alias("words"))
    )
    # One row a distinct (host, path, rule) from here on: hot urls collapse before any join.
    groups = urls.groupBy("host", "path", "rule", "tokens").agg(F.count("*").alias("n"))
    tokens = F.concat(F.coalesce("words", F.expr("CAST(array() AS array<string>)")), "tokens")
    groups = materialize(groups.join(host_words, "host", "left").select("host", "path", "rule", "n", tokens.alias("tokens")), "url-groups")

    verdicts = {r.name: r.verdict for r in rules}
    lexicon = F.array(*(F.lit(w) for w in SPAM_WORDS))
    examples = groups.withColumn("block", F.arrays_overlap("tokens", lexicon))
    learned = (
        examples.select(F.explode("tokens").alias("token"), "block", "n")
        .groupBy("token")
        .agg(
            F.sum(F.when(F.col("block"), 0).otherwise(F.col("n"))).cast("double").alias("allow"),
            F.sum(F.when(F.col("block"), F.col("n")).otherwise(0)).cast("double").alias("block"),
        )
    )
    learned = materialize(learned, "url-tokens")
    n = {r["block"]: r["n"] for r in examples.groupBy("block").agg(F.sum("n").alias("n")).collect()}
    prior = math.log((n.get(True, 0) + 1) / (n.get(False, 0) + 2))
    sums = learned.agg(F.sum("allow").alias("a"), F.sum("block").alias("b"), F.count("*").alias("v")).first()
    a, b, v = sums["a"] or 0.0, sums["b"] or 0.0, sums["v"]
    odds = F.log((F.col("block") + 1) / F.lit(b + v + 1)) - F.log((F.col("allow") + 1) / F.lit(a + v + 1))
    # A token that nearly every url has (com, www) would meet its odds in one task: the few tokens with
    # more than a HOT_SHARE-th of all occurrences, of which there are fewer than that, are broadcast.
    weighed = learned.select("token", odds.alias("odds"), (F.col("allow") + F.col("block")).alias("n"))
    hot = F.col("n") * HOT_SHARE > F.lit(a + b)
    counted = groups.select("host", "path", F.explode("tokens").alias("token")).groupBy("host", "path", "token").agg(F.count("*").alias("times"))
    counted = counted.join(F.broadcast(weighed.where(hot).select("token", F.col("odds").alias("hot"))), "token", "left")
    own = F.when(F.col("hot").isNull(), F.col("token")).otherwise(F.concat(F.lit("\u0000"), "host", "path"))
    cold = weighed.where(~hot).select(F.col("token").alias("at"), "odds")
    scored = (
        counted.withColumn("at", own)
        .join(cold, "at", "left")
        .groupBy("host", "path")
        .agg(F.sum(F.col("times") * F.coalesce("hot", "odds")).alias("odds"))
    )
    spam_score = F.lit(prior) + F.coalesce("odds", F.lit(0.0))
    by_rule = F.create_map(*[F.lit(x) for kv in verdicts.items() for x in kv])
    method = F.when(spam_score > 0, "block").otherwise("allow")
    return (
        urls.select(*keep, "host", "path", "rule")
        .join(scored, ["host", "path"], "left")
        .select(*keep, "host", "path", "rule", F.coalesce(by_rule[F.col("rule")], method).alias("verdict"), spam_score.alias("spam_score"))
    )
