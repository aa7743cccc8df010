"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from . import decontaminate, secret_scan

NEAREST = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN CAST(embedding AS DOUBLE[]) IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN CAST(embedding AS DOUBLE[]) IF x <> 0]) > 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""

#: Every window of every item's size that shares a shingle with the item, compared exactly.
LEAKS = f"""
WITH words AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents
  UNION ALL SELECT 'i', item_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') FROM benchmark),
sizes AS (
  SELECT id AS item, len(w) AS n, least({decontaminate.SHINGLE}, len(w)) AS k, w FROM words WHERE side = 'i' AND len(w) > 0),
item_shingles AS (
  SELECT item, n, k, s, COUNT(*) AS many
  FROM (SELECT item, n, k, unnest([array_to_string(w[p:p + k - 1], ' ') FOR p IN range(1, n - k + 2)]) AS s
        FROM sizes) t GROUP BY ALL),
doc_shingles AS (
  SELECT id AS doc, len(w) AS total, k, unnest(range(0, len(w) - k + 1)) AS pos,
         unnest([array_to_string(w[p:p + k - 1], ' ') FOR p IN range(1, len(w) - k + 2)]) AS s
  FROM words, (SELECT DISTINCT k FROM sizes) ks WHERE side = 'd' AND len(w) >= k),
hits AS (
  SELECT doc, item, n, d.k, total, pos, s, many, least(n - d.k + 1, total - d.k + 1) AS span
  FROM doc_shingles d JOIN item_shingles i USING (k, s)),
starts AS (
  SELECT DISTINCT doc, item, n, k, total, span, unnest(range(greatest(0, pos - span + 1), least(pos, total - k + 1 - span) + 1)) AS start
  FROM hits),
shared AS (
  SELECT doc, item, start, n, k, total, span, SUM(least(here, many)) AS common
  FROM (SELECT t.doc, t.item, t.start, t.n, t.k, t.total, t.span, h.s, h.many, COUNT(*) AS here
        FROM starts t JOIN hits h ON t.doc = h.doc AND t.item = h.item AND h.pos >= t.start AND h.pos < t.start + t.span
        GROUP BY ALL) c GROUP BY ALL),
scored AS (
  SELECT doc, item, start, n, total, CAST(common AS DOUBLE) / CAST(n - k + 1 + span - common AS DOUBLE) AS similarity FROM shared),
best AS (
  SELECT *, row_number() OVER (PARTITION BY doc, item ORDER BY similarity DESC, start) AS place
  FROM scored WHERE similarity >= {decontaminate.THRESHOLD})
SELECT doc AS doc_id, item AS item_id, similarity, CAST(start AS INTEGER) AS start_word,
       CAST(least(n, total) AS INTEGER) AS n_words
FROM best WHERE place = 1"""


LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Every document that shares a term with the item, scored.
RANKED = f"""
WITH terms AS (
  SELECT 'd' AS side, doc_id AS id, row_number() OVER () AS row, regexp_extract_all(translate(text, '{LETTERS}', '{LETTERS.lower()}'),
         '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents
  UNION ALL SELECT 'i', item_id, 0, regexp_extract_all(translate(text, '{LETTERS}', '{LETTERS.lower()}'),
         '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') FROM benchmark),
asked AS (SELECT DISTINCT id AS item_id, unnest(w) AS t FROM terms WHERE side = 'i' AND id IS NOT NULL),
held AS (SELECT id, row, n, t, COUNT(*) AS tf FROM (
  SELECT id, row, len(w) AS n, unnest(w) AS t FROM terms WHERE side = 'd') x GROUP BY ALL),
totals AS (SELECT COUNT(*) AS many, CAST(SUM(len(w)) AS BIGINT) AS total FROM terms WHERE side = 'd' AND len(w) > 0),
weights AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * many + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS weight
  FROM (SELECT t, COUNT(*) AS df FROM held GROUP BY t) x, totals),
scored AS (
  SELECT item_id, id AS doc_id, row, CAST(SUM(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * many) // total)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (t) JOIN held USING (t), totals GROUP BY item_id, id, row),
placed AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 50"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secrets() -> str:
    """Places of the matches of each pattern: what ``string_split_regex`` leaves between
    them and what ``regexp_extract_all`` returns, added up."""
    patterns = {
        "assign": secret_scan.ASSIGN.pattern.replace("(?ai:", "(?i:"),
        "access": secret_scan.ACCESS.pattern,
        "hex": secret_scan.HEX.pattern.replace("(?<![0-9a-f])", ""),
        **{kind: pattern.pattern for kind, (_, pattern) in secret_scan.FORMATS.items()}}
    keep = {"assign": "length(g) >= 8", "access": "length(m) >= 16"}
    parts = [f"""
SELECT doc_id, {n} AS place, {_quoted(kind)} AS kind, unnest(range(1, len(m) + 1)) AS i, m, g, gaps FROM (
  SELECT doc_id, regexp_extract_all(text, {_quoted(p)}) AS m,
         regexp_extract_all(text, {_quoted(p)}, {int(kind == "assign")}) AS g,
         string_split_regex(text, {_quoted(p)}) AS gaps FROM documents) t""" for n, (kind, p) in enumerate(patterns.items())]
    return f"""
WITH found AS ({' UNION ALL '.join(parts)}),
spans AS (
  SELECT doc_id, place, kind, m[i] AS m, g[i] AS g,
         CAST(list_sum([length(x) FOR x IN gaps[1:i]]) + coalesce(list_sum([length(x) FOR x IN m[1:i - 1]]), 0) AS BIGINT) AS start
  FROM found),
kept AS (
  SELECT *, kind || ':' || start || ':' || (start + length(m)) AS span FROM spans
  WHERE CASE kind {' '.join(f"WHEN {_quoted(k)} THEN {c}" for k, c in keep.items())} ELSE true END)
SELECT d.doc_id, {', '.join(f"COUNT(*) FILTER (WHERE kind = {_quoted(k)}) AS n_{k}" for k in secret_scan.BASE)},
       sha256(coalesce(string_agg(span, ',' ORDER BY start, place) FILTER (WHERE place < {len(secret_scan.BASE)}), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, place), '') AS spans
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id GROUP BY d.doc_id"""


ORACLE = {"op1_decontamination": LEAKS, "op3_nearest_neighbours": NEAREST, "op9_secret_scan": _secrets(),
          "op12_lexical_search": RANKED}
