"""DuckDB SQL for the queries of this subpackage that SQL can express on whole tables."""

from __future__ import annotations

# Kind, pattern, the group whose length counts, its least length.
_KINDS = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
    ("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 1),
    ("forge", r"\bgh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("chat", r"\bxox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    ("url_login", r"[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s/:@]{1,64}:[^\s/:@]{3,128}@", 0, 1),
]


def _spans(order: int, kind: str, pattern: str, group: int, least: int) -> str:
    """One row a match: its start from the lengths of what lies before it."""
    p = "'" + pattern.replace("'", "''") + "'"
    before = (
        "list_sum(list_transform(p[1:i], lambda x: length(x))) "
        "+ COALESCE(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)"
    )
    return f"""SELECT doc_id, unnest(list_filter(list_transform(range(1, len(m) + 1), lambda i: {{
    'start': CAST({before} AS BIGINT), 'ord': {order}, 'kind': '{kind}', 'size': length(m[i]), 'own': length(g[i])}}),
    lambda x: x.own >= {least})) AS s
  FROM (SELECT doc_id, regexp_extract_all(t, {p}, 0) AS m, regexp_extract_all(t, {p}, {group}) AS g,
               regexp_split_to_array(t, {p}) AS p
        FROM d WHERE regexp_matches(t, {p}))"""


def _secrets() -> str:
    found = "\n  UNION ALL ".join(_spans(i, *k) for i, k in enumerate(_KINDS))
    span = "s.kind || ':' || s.start || ':' || (s.start + s.size)"
    return f"""WITH d AS (SELECT doc_id, COALESCE(text, '') AS t FROM documents),
found AS ({found}),
per_document AS (
  SELECT doc_id, count(*) FILTER (WHERE s.kind = 'assign') AS n_assign, count(*) FILTER (WHERE s.kind = 'access') AS n_access,
    count(*) FILTER (WHERE s.kind = 'hex') AS n_hex, string_agg({span}, ',' ORDER BY s.start, s.ord) FILTER (WHERE s.ord < 3) AS base,
    string_agg({span}, ',' ORDER BY s.start, s.ord) AS spans FROM found GROUP BY doc_id)
SELECT d.doc_id, COALESCE(n_assign, 0) AS n_assign, COALESCE(n_access, 0) AS n_access, COALESCE(n_hex, 0) AS n_hex,
  sha256(COALESCE(base, '')) AS base_sha256, COALESCE(spans, '') AS spans
FROM d LEFT JOIN per_document f ON f.doc_id = d.doc_id"""


# All pairs that share a shingle, their exact similarity, and the smallest id reachable.
_NEAR = r"""WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3),
                               lambda i: array_to_string(w[i:i + 4], ' ')))
                             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, root) AS (SELECT doc_id, doc_id FROM documents
  UNION SELECT s.b, r.root FROM reach r JOIN sides s ON s.a = r.node AND s.b > r.root),
least AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)
SELECT doc_id, COALESCE(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN least ON least.node = doc_id"""

# Payloads by their digest; the smallest id of a payload of 100 bytes or more is what the others revisit.
_WARC = """WITH p AS (SELECT page_id, sha256(COALESCE(html, '')) AS payload_digest, strlen(COALESCE(html, '')) AS payload_bytes FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS least FROM p),
r AS (SELECT *, CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM least THEN least END AS refers_to FROM f)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM r"""

ORACLE: dict[str, str] = {"op1_secret_scans": _secrets(), "op7_minhash": _NEAR, "op13_warc": _WARC}
