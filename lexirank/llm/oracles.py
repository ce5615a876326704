"""DuckDB SQL for the queries whose results SQL can express."""

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP3 = rf"""
WITH item AS (
    SELECT row_number() OVER () AS item_row, CAST(item_id AS VARCHAR) AS item_id,
           regexp_extract_all(translate(text, {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL),
win AS (
    SELECT DISTINCT item_row, item_id, least(13, len(w)) AS k, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS phrase
    FROM item, unnest(range(1, greatest(len(w) - 11, 2))) AS r(i) WHERE len(w) > 0),
doc AS (
    SELECT row_number() OVER () AS doc_row, doc_id,
           coalesce(regexp_extract_all(translate(text, {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents),
pos AS (
    SELECT doc_row, i, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM doc, unnest(range(1, len(w) + 1)) AS r(i), (SELECT DISTINCT k FROM win) WHERE i + k - 1 <= len(w)),
occ AS (SELECT doc_row, i, pos.k, item_id FROM pos JOIN win ON pos.phrase = win.phrase AND pos.k = win.k),
hit AS (SELECT doc_row, count(DISTINCT j) AS n_hit FROM occ, unnest(range(i, i + k)) AS r(j) GROUP BY 1),
its AS (
    SELECT doc_row, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_row, item_id FROM occ WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_row) LEFT JOIN its USING (doc_row)
"""

OP2 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
g AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM d LEFT JOIN g USING (payload_digest)
"""

OP10 = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s FROM w),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM s),
g AS (SELECT doc_id, unnest(s) AS t FROM s),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
both_ways AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, both_ways.y FROM r JOIN both_ways ON r.b = both_ways.x)
SELECT n.doc_id, n.n AS n_shingles, min(r.b) AS component_id FROM n JOIN r ON r.a = n.doc_id GROUP BY 1, 2
"""

_KINDS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("forge", r"gh[opsu]_[A-Za-z0-9]{36,}", 0, 1),
    ("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
]


def _of_kind(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    p = "'" + pattern.replace("'", "''") + "'"
    return f"""
    SELECT doc_row, {rank} AS rank, '{kind}' AS kind, s AS start, s + len(m[i]) AS "end" FROM (
        SELECT doc_row, m, i, CAST(list_sum(list_transform(gaps[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: len(x))), 0) AS BIGINT) AS s
        FROM (SELECT doc_row, string_split_regex(text, {p}) AS gaps, regexp_extract_all(text, {p}) AS m, regexp_extract_all(text, {p}, {group}) AS part FROM doc),
             unnest(range(1, len(m) + 1)) AS r(i) WHERE len(part[i]) >= {least})"""


_SPAN = "kind || ':' || start || ':' || \"end\""

OP9 = f"""
WITH doc AS (SELECT row_number() OVER () AS doc_row, doc_id, coalesce(text, '') AS text FROM documents),
span AS ({" UNION ALL ".join(_of_kind(i, *k) for i, k in enumerate(_KINDS))}),
all_of AS (
    SELECT doc_row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg({_SPAN}, ',' ORDER BY start, rank) FILTER (rank < 3) AS base, string_agg({_SPAN}, ',' ORDER BY start, rank) AS spans
    FROM span GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM doc LEFT JOIN all_of USING (doc_row)
"""


def _lloyd(rounds: int) -> str:
    """CTEs cb0 (the first codebooks), then of each round a (nearest entries, d * 256 + e) and the next cb, and a last a."""
    out = ""
    for r in range(rounds + 1):
        out += f""",
a{r} AS MATERIALIZED (
    SELECT row, p, min(256 * CAST(list_sum(list_transform(range(1, len(parts.x) + 1), lambda j: (parts.x[j] - cb{r}.x[j]) * (parts.x[j] - cb{r}.x[j]))) AS BIGINT) + e) AS m
    FROM parts JOIN cb{r} USING (p) GROUP BY 1, 2)"""
        if r < rounds:
            out += f""",
m{r} AS (
    SELECT p, e, list(CAST(floor(s / n) AS BIGINT) ORDER BY j) AS x FROM (
        SELECT a.p, a.m % 256 AS e, j, CAST(sum(parts.x[j]) AS DOUBLE) AS s, count(*) AS n
        FROM a{r} a JOIN parts ON a.row = parts.row AND a.p = parts.p, unnest(range(1, len(parts.x) + 1)) AS u(j) GROUP BY 1, 2, 3) GROUP BY 1, 2),
cb{r + 1} AS MATERIALIZED (SELECT cb{r}.p, cb{r}.e, coalesce(m{r}.x, cb{r}.x) AS x FROM cb{r} LEFT JOIN m{r} ON m{r}.p = cb{r}.p AND m{r}.e = cb{r}.e)"""
    return out


OP12 = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id) - 1 AS row, vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT row, p, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] AS x FROM kept, unnest(range(4)) AS r(p)),
cb0 AS (SELECT p, row AS e, x FROM parts WHERE row < 256){_lloyd(4)},
coded AS (
    SELECT row, string_agg(lpad(lower(to_hex(m % 256)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(m // 256) AS BIGINT) AS error FROM a4 GROUP BY 1),
books AS (
    SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM cb4)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (row), books
"""
