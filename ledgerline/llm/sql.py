"""SQL for another engine that must give the queries' rows; written apart from the operators."""

from __future__ import annotations

from .license_scan import MAX_STRETCH, MIN_SHARE, Template

_AZ = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# Words of digits, letters and non-ASCII characters; words between ASCII blanks.
_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_BLANK_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

URL_FILTERS = f"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, {_AZ.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(rank, verdict, host_rule, path_rule) AS (
  VALUES (1, 'allow', 'com', '/'), (2, 'block', 'example.com', '/en/'), (3, 'allow', 'www.example.com', '/en/'),
         (4, 'block', 'net', '/es/'), (5, 'block', 'net', '/fr/')
), fits AS (
  SELECT page_id, arg_max(host_rule || path_rule, length(host_rule || path_rule)) AS rule,
         arg_max(r.verdict, length(host_rule || path_rule)) AS verdict
  FROM split s JOIN rules r
    ON (s.host = r.host_rule OR ends_with(s.host, '.' || r.host_rule)) AND starts_with(s.path, r.path_rule)
  GROUP BY page_id
)
SELECT s.page_id, s.host, s.path, f.rule,
       CASE WHEN f.verdict IS NOT NULL THEN f.verdict
            WHEN s.host = '' THEN 'block'
            WHEN contains(s.host, 'ads-track') OR regexp_matches(s.host, 'tracker\\.')
              OR contains(s.path, '/cgi-bin/') OR ends_with(s.host || s.path, '.exe') THEN 'block'
            ELSE 'allow' END AS verdict
FROM split s LEFT JOIN fits f USING (page_id)
"""


def license_scan(templates: tuple[Template, ...]) -> str:
    rows = ", ".join(f"({i}, '{t.label}', {t.exact}, string_split('{t.words}', ' '))" for i, t in enumerate(templates))
    return f"""
WITH docs AS (
  SELECT doc_id, {_WORDS.format(_AZ.format("coalesce(text, '')"))} AS w FROM documents
), templates(t, label, exact, tw) AS (VALUES {rows}
), runs AS (
  SELECT t, label, exact, len(tw) - 2 AS runs, unnest(range(len(tw) - 2)) AS p, tw FROM templates
), grams AS (
  SELECT t, p, tw[p + 1] || ' ' || tw[p + 2] || ' ' || tw[p + 3] AS gram FROM runs
), places AS (
  SELECT doc_id, unnest(range(len(w) - 2)) AS pos, w FROM docs WHERE len(w) >= 3
), votes AS (
  SELECT DISTINCT doc_id, t, pos, p, pos - p AS diagonal
  FROM (SELECT doc_id, pos, w[pos + 1] || ' ' || w[pos + 2] || ' ' || w[pos + 3] AS gram FROM places) JOIN grams USING (gram)
), meta AS (SELECT DISTINCT t, label, exact, runs FROM runs
), full_places AS (
  SELECT doc_id, t, diagonal FROM votes JOIN meta USING (t) WHERE exact
  GROUP BY doc_id, t, diagonal, runs HAVING count(DISTINCT p) = runs
), base AS (
  SELECT doc_id, count(*) AS n_base, min(diagonal) AS first_word, max(diagonal) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM full_places JOIN meta USING (t) GROUP BY doc_id
), anchors AS (SELECT DISTINCT doc_id, t, diagonal FROM votes
), found AS (
  SELECT a.doc_id, a.t, a.diagonal, label, count(DISTINCT p) / runs AS share
  FROM anchors a JOIN meta USING (t) JOIN votes v ON v.doc_id = a.doc_id AND v.t = a.t
    AND v.diagonal BETWEEN a.diagonal AND a.diagonal + {MAX_STRETCH - 1} * (runs + 2)
  WHERE NOT exact GROUP BY a.doc_id, a.t, a.diagonal, label, runs
), more AS (
  SELECT doc_id, label FROM found WHERE share >= {MIN_SHARE}
  UNION SELECT doc_id, label FROM full_places JOIN meta USING (t)
), named AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM more GROUP BY doc_id
), best AS (SELECT doc_id, max(share) AS score FROM found GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(CASE WHEN n_base > 0 THEN 1 ELSE coalesce(score, 0) END AS DOUBLE) AS score
FROM docs d LEFT JOIN base USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN best USING (doc_id)
"""


def line_dedup(min_sites: int, source: str = "documents") -> str:
    return f"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS raw, unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM {source}
), trimmed AS (
  SELECT doc_id, source, raw, pos, trim(raw, ' ' || chr(9) || chr(13)) AS line FROM lines
), spread AS (
  SELECT line FROM trimmed WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= {min_sites}
), marked AS (
  SELECT t.*, s.line IS NOT NULL AS hit FROM trimmed t LEFT JOIN spread s ON t.line = s.line
), done AS (
  SELECT doc_id, string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE NOT hit) AS text,
         count(*) AS n_lines, count(*) FILTER (WHERE hit) AS n_removed
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(done.text, '') END AS text
FROM {source} d LEFT JOIN done USING (doc_id)
"""


DECONTAMINATION = f"""
WITH docs AS (
  SELECT doc_id, {_WORDS.format(_AZ.format("coalesce(text, '')"))} AS w FROM documents
), items AS (
  SELECT item_id, {_WORDS.format(_AZ.format("coalesce(text, '')"))} AS w FROM benchmark
), grams AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[p:p + 9], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS p FROM items WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM grams
), seen AS (
  SELECT doc_id, size, p, array_to_string(w[p:p + size - 1], ' ') AS gram
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM docs, sizes WHERE len(w) >= size)
), hits AS (SELECT doc_id, p, s.size, item_id FROM seen s JOIN grams g ON s.gram = g.gram AND s.size = g.size
), words AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS spot FROM hits) GROUP BY doc_id
), owners AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hits GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN words USING (doc_id) LEFT JOIN owners USING (doc_id)
"""

QUALITY = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents
), split AS (SELECT doc_id, text, {_BLANK_WORDS.format("text")} AS w FROM docs
), windows AS (
  SELECT doc_id, p, array_to_string(w[p:p + 7], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS p FROM split WHERE len(w) >= 8)
), twice AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM windows
), repeats AS (
  SELECT doc_id, count(DISTINCT spot) AS n FROM (SELECT doc_id, unnest(range(p, p + 8)) AS spot FROM twice WHERE n > 1) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
), facts AS (
  SELECT s.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         length(regexp_replace(text, '[^!?]', '', 'g')) AS n_marks,
         coalesce(l.n, 0) AS n_lines, CAST(coalesce(l.dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM split s LEFT JOIN lines l USING (doc_id) LEFT JOIN repeats r USING (doc_id)
), judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM facts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_marks > n_words OR 2 * n_dup_lines > n_lines
            OR word_chars > 20 * n_words OR word_chars < 2 * n_words) AS kept
FROM judged
"""
