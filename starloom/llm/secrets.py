"""Secret scans with an incremental blob ledger.

Every historical version of a file is content-addressed (SHA-256 of its text). The ledger holds one
row per scanned (blob, rule version) pair with its findings; a run scans only the pairs the ledger
lacks, appends them, and joins the findings back to every path and version that holds the blob.

Defined results: a null or empty text has no findings; repeated rows each get the blob's findings;
texts of any length are scanned whole; an empty table gives an empty result; extra columns are
ignored unless they are named as keys.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import claim, slices

FINDINGS = "array<struct<kind:string,start:bigint,end:bigint>>"
LEDGER_SCHEMA = f"blob string, rule_version string, findings {FINDINGS}"
BASE_KINDS = ("assign", "access", "hex")


@dataclass(frozen=True)
class Rule:
    """``pattern`` runs over the whole text; matches whose ``group`` is shorter than ``least`` are
    dropped after the search. ``hints``: one of these (in lower case) must occur, else no search."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    flags: int = 0
    hints: tuple[str, ...] = ()


RULES: tuple[Rule, ...] = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=8,
        flags=re.ASCII | re.IGNORECASE,
        hints=("password", "passwd", "secret", "token", "apikey", "api_key"),
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=16, hints=("akia",)),
    Rule("hex", r"[0-9a-f]{32,}", least=32),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", hints=("-----begin ",)),
    Rule("forge", r"\bgh[pousr]_[A-Za-z0-9]{36,}", hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("chat", r"\bxox[abprs]-[A-Za-z0-9-]{10,}", hints=("xox",)),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hints=("eyj",)),
    Rule("url_login", r"[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s/:@]{1,64}:[^\s/:@]{3,128}@", hints=("://",)),
)


def rule_version(rules: tuple[Rule, ...] = RULES) -> str:
    """Changes whenever a rule does, so old ledger rows are not taken for new rules."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = [(r, re.compile(r.pattern, r.flags)) for r in rules]

    def __call__(self, text: str | None) -> list[tuple[str, int, int]]:
        """(kind, start, end) by start, then rule order; code points, end exclusive."""
        if not text:
            return []
        low, found = text.lower(), []
        for order, (rule, pattern) in enumerate(self.rules):
            if rule.hints and not any(h in low for h in rule.hints):
                continue
            for m in pattern.finditer(text):
                a, b = m.span(rule.group)
                if b - a >= rule.least:
                    found.append((m.start(), order, rule.kind, m.end()))
        return [(kind, start, end) for start, _, kind, end in sorted(found)]


def _scan_blobs(rules: tuple[Rule, ...], version: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("secrets")
        scan = Scanner(rules)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in (part for batch in batches for part in slices(batch, "content")):
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in scan(t)] for t in b.column("content").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("blob").cast(pa.string()), pa.array([version] * len(found), pa.string()), pa.array(found, kind)],
                ["blob", "rule_version", "findings"],
            )

    return run


def _exists(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_ledger(spark, ledger: str) -> DataFrame:
    if not _exists(spark, ledger):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)


# Blobs with findings that are broadcast at most when findings are joined back (about 30 MB); beyond
# that the join is a shuffled one.
BROADCAST_BLOBS = 200_000


def scan_versions(
    versions: DataFrame, keys: list[str], ledger: str, content: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Scan the blobs the ledger lacks, append them to it, and return ``keys``, blob, findings: one
    row per input row.

    One text per distinct blob is shuffled (copies within a map task collapse before it). The join
    back moves keys and hashes only, and nothing where few blobs have findings; a blob that a third of
    all paths hold is an ordinary skewed join that Spark splits.
    """
    spark, version = versions.sparkSession, rule_version(rules)
    rows = versions.withColumn("__content", F.coalesce(F.col(content).cast("string"), F.lit("")))
    rows = rows.withColumn("__blob", F.sha2("__content", 256))
    blobs = rows.groupBy(F.col("__blob").alias("blob")).agg(F.first("__content").alias("content"))
    if _exists(spark, ledger):
        seen = read_ledger(spark, ledger).where(F.col("rule_version") == version).select("blob")
        blobs = blobs.join(seen, "blob", "left_anti")
    blobs.mapInArrow(_scan_blobs(rules, version), LEDGER_SCHEMA).write.mode("append").parquet(ledger)
    # A run that died after its append leaves rows that a rerun skips; equal rows from two runs at
    # the same time collapse here.
    found = (
        read_ledger(spark, ledger)
        .where((F.col("rule_version") == version) & (F.size("findings") > 0))
        .groupBy(F.col("blob").alias("__blob"))
        .agg(F.first("findings").alias("__findings"))
    )
    if found.count() <= BROADCAST_BLOBS:
        found = F.broadcast(found)
    none = F.expr(f"CAST(array() AS {FINDINGS})")
    return (
        rows.select(*keys, "__blob")
        .join(found, "__blob", "left")
        .select(*keys, F.col("__blob").alias("blob"), F.coalesce("__findings", none).alias("findings"))
    )


def spans_text(findings, kinds: tuple[str, ...] | None = None):
    """``kind:start:end`` joined by commas, in the order of the findings."""
    kept = F.filter(findings, lambda x: x["kind"].isin(*kinds)) if kinds else findings
    one = F.transform(kept, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
    return F.concat_ws(",", one)


def redact(text: str, findings: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    """The text with every finding replaced; overlapping findings become one mark."""
    out, at = [], 0
    for _, start, end in sorted(findings, key=lambda x: (x[1], -x[2])):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in (part for batch in batches for part in slices(batch, "text")):
        texts = b.column("text").to_pylist()
        for i, found in enumerate(b.column("findings").to_pylist()):
            if found and texts[i]:
                texts[i] = redact(texts[i], [(f["kind"], f["start"], f["end"]) for f in found])
        names = [n for n in b.schema.names if n != "findings"]
        columns = {n: pa.array(texts, pa.string()) if n == "text" else b.column(n) for n in names}
        if "n_chars" in columns:
            kept = b.column("n_chars").to_pylist()
            sizes = [len(t) if t is not None and f else n for t, f, n in zip(texts, b.column("findings").to_pylist(), kept, strict=True)]
            columns["n_chars"] = pa.array(sizes, b.column("n_chars").type)
        yield pa.RecordBatch.from_arrays(list(columns.values()), names)


def redact_versions(docs: DataFrame, ledger: str) -> DataFrame:
    """All rows and columns of ``docs``; the findings of ``text`` replaced, ``n_chars`` adjusted."""
    found = scan_versions(docs, docs.columns, ledger).drop("blob")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return found.mapInArrow(_redact, fields)
