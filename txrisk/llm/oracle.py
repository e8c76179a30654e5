"""The numbered operators in SQL, where SQL can express them on whole tables."""

from __future__ import annotations

_WHITE = r"[\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP7 = rf"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{_WHITE}', ' ', 'g') AS n FROM documents),
g AS (SELECT n, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n) AS text_sha256 FROM t JOIN g USING (n)
"""

OP5 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WHITE}'), lambda x: x <> '') AS w
  FROM documents
),
s AS MATERIALIZED (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) < 2 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS s
  FROM w WHERE len(w) > 0
),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
link AS MATERIALIZED (
  SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
),
tie AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS root, doc_id AS id FROM documents UNION SELECT root, b FROM reach JOIN tie ON a = id),
least AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN least ON id = d.doc_id
"""

OP11 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WHITE}'), lambda x: x <> '') AS w
  FROM documents
),
s AS MATERIALIZED (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s
  FROM w WHERE len(w) > 0
),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
link AS MATERIALIZED (
  SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
),
tie AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS root, doc_id AS id FROM documents UNION SELECT root, b FROM reach JOIN tie ON a = id),
least AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN least ON id = d.doc_id
"""

OP10 = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS keeper, sha1(html) AS h FROM p)
SELECT page_id, octet_length(encode(html)) AS payload_bytes,
  array_to_string(list_transform(range(8), lambda g: array_to_string(list_transform([15, 10, 5, 0],
    lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, 5 * g + 1, 5))::BIGINT >> k) & 31)::BIGINT + 1, 1)), '')), '') AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = keeper THEN NULL ELSE keeper END AS refers_to,
  url AS uri
FROM q
"""


def statements() -> dict[str, str]:
    return {"op5_minhash_tensor": OP5, "op7_exact_copies": OP7, "op10_warc_transactions": OP10, "op11_jaccard_tiles": OP11}
