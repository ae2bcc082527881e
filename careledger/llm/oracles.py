"""DuckDB SQL for the rows of registered queries, where SQL can express them: stated from the contracts, by plain
self-joins and windows over whole tables."""

from __future__ import annotations

from careledger.llm import secrets

OP1 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
     q AS (SELECT page_id, strlen(body) AS payload_bytes, sha256(body) AS payload_digest,
                  min(page_id) OVER (PARTITION BY body) AS head FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> head THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> head THEN head END AS refers_to
FROM q"""

OP2 = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS s
  FROM texts),
-- documents with one set are one class
classes AS (SELECT s, min(doc_id) AS rep, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
shingles AS (SELECT rep, n, unnest(s) AS g FROM classes),
links AS (
  SELECT a.rep AS a, b.rep AS b FROM shingles a JOIN shingles b ON a.g = b.g AND a.rep < b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT rep AS node, rep AS low FROM classes
  UNION
  SELECT e.b, r.low FROM reach r JOIN edges e ON e.a = r.node WHERE r.low < e.b),
roots AS (SELECT node, min(low) AS root FROM reach GROUP BY node)
SELECT s.doc_id, len(s.s) AS n_shingles, coalesce(c.rep, s.doc_id) AS class_id, coalesce(r.root, s.doc_id) AS component_id
FROM sets s LEFT JOIN classes c ON c.s = s.s LEFT JOIN roots r ON r.node = c.rep"""

OP3 = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
     best AS (SELECT norm, count(*) AS group_size, arg_min(doc_id, (-chars, doc_id)) AS keep_id FROM t GROUP BY norm)
SELECT t.doc_id, best.keep_id, best.group_size, t.doc_id = best.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN best ON t.norm = best.norm"""

OP5 = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS x FROM documents),
sized AS (SELECT *, octet_length(x) AS n FROM t),
windows AS (SELECT r, doc_id, p, array_slice(x, p + 1, p + 50) AS w FROM sized, LATERAL (SELECT unnest(range(n - 49)) AS p) WHERE n >= 50),
least AS (SELECT w, min(doc_id) AS low FROM windows GROUP BY w HAVING count(*) > 1),
gone AS (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM windows JOIN least USING (w) WHERE low < doc_id),
runs AS (
  SELECT r, run, min(p) AS a, max(p) + 50 AS b FROM (
    SELECT r, p, count(*) FILTER (before IS NULL OR p > before + 50) OVER (PARTITION BY r ORDER BY p) AS run FROM gone) GROUP BY r, run),
per AS (SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed FROM runs GROUP BY r),
pieces AS (
  SELECT r, a AS pos, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS lo, a AS hi FROM runs
  UNION ALL SELECT r, n + 1, coalesce((SELECT max(b) FROM runs WHERE runs.r = sized.r), 0), n FROM sized),
kept AS (SELECT r, string_agg(CASE WHEN hi > lo THEN hex(array_slice(x, lo + 1, hi)) ELSE '' END, '' ORDER BY pos) AS h FROM pieces JOIN sized USING (r) GROUP BY r)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(h)) AS kept_sha256
FROM sized JOIN kept USING (r) LEFT JOIN per USING (r)"""

OP13 = r"""
WITH numbered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                            left(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32)) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
-- unsigned crc32 of the decimal id, bit by bit
heads AS (
  SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]),
          lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM numbered)),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, b.k, b.role, b.text FROM heads c JOIN numbered b ON b.conv_id = c.conv_id - c.conv_id % 5 AND b.k <= c.h
  UNION ALL
  SELECT c.conv_id, 1, n.k, n.role, n.text FROM heads c JOIN numbered n ON n.conv_id = c.conv_id AND n.k > c.h),
paths AS (
  SELECT heads.conv_id, coalesce(list({'role': role, 'text': text} ORDER BY part, k) FILTER (part IS NOT NULL), []) AS path
  FROM heads LEFT JOIN rebuilt USING (conv_id) GROUP BY heads.conv_id),
members AS (SELECT conv_id, path, unnest(range(len(path) + 1)) AS depth FROM paths),
nodes AS (
  SELECT path[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(path) = depth), '') AS ends
  FROM members GROUP BY ALL),
tree AS (
  SELECT n.*, p.conv_id AS parent_conv_id, CASE WHEN n.depth > 0 THEN (n.n_convs - 1) * strlen(n.node[n.depth].text) ELSE 0 END AS saved
  FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.node = n.node[1:n.depth - 1]),
children AS (SELECT node[1:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
below AS (
  SELECT t.node[1:a.up] AS node, sum(saved) AS saved, count(*) FILTER (c.n IS NULL) AS leaves
  FROM tree t LEFT JOIN children c ON c.node = t.node, LATERAL (SELECT unnest(range(t.depth + 1)) AS up) a GROUP BY 1)
SELECT t.conv_id, t.depth, t.parent_conv_id, t.n_convs, coalesce(c.n, 0) AS n_children, b.leaves AS n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, sha256(t.ends) AS ends_sha256
FROM tree t JOIN below b ON b.node = t.node LEFT JOIN children c ON c.node = t.node"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def secret_spans(rules: tuple[secrets.Rule, ...], base: int) -> str:
    """Spans from the text between matches; the first ``base`` rules are the contract's."""
    raw = " UNION ALL ".join(f"""
  SELECT r, {no} AS no, {_quoted(x.kind)} AS kind, {x.least} AS least, string_split_regex(x, {_quoted(x.regex)}) AS gaps,
         regexp_extract_all(x, {_quoted(x.regex)}) AS found, regexp_extract_all(x, {_quoted(x.regex)}, {x.group}) AS checked
  FROM t WHERE regexp_matches(x, {_quoted(x.regex)})""" for no, x in enumerate(rules))
    names = [x.kind for x in rules[:base]]
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x FROM documents),
raw AS ({raw}),
hits AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM raw),
spans AS (
  SELECT r, no, kind, CAST(list_sum(list_transform(gaps[1:i], lambda s: length(s)))
                           + coalesce(list_sum(list_transform(found[1:i - 1], lambda s: length(s))), 0) AS BIGINT) AS a, length(found[i]) AS n
  FROM hits WHERE length(checked[i]) >= least),
told AS (
  SELECT r, string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, no) AS spans,
         string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, no) FILTER (no < {base}) AS base,
         {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in names)}
  FROM spans GROUP BY r)
SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in names)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN told USING (r)"""


ORACLES: dict[str, str] = {
    "op1_warc": OP1,
    "op2_ngram_jaccard_join": OP2,
    "op3_exact_dedup": OP3,
    "op5_suffix_dedup": OP5,
    "op9_secret_scan": secret_spans(secrets.RULES, len(secrets.BASE_RULES)),
    "op13_conversation_trie": OP13,
}
