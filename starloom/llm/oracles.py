"""The document queries in DuckDB's SQL, where SQL can express them."""

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"
_BLANK = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _count(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, '{pattern}'))"


_PHRASES = ["all rights reserved", "privacy policy", "cookies", "javascript", "lorem ipsum", "newsletter"]
_FURNITURE = " OR ".join(f"contains(lower(line), '{p}')" for p in _PHRASES)

OP1 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS.format('text')} AS w FROM documents),
grams AS (
  SELECT doc_id, i, w[i:i+2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id
),
lines AS (
  SELECT doc_id, line, len({_WORDS.format('line')}) AS n, len(array_to_string({_WORDS.format('line')}, '')) AS chars
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
),
judged AS (
  SELECT doc_id, line, n, chars, n > 0 AND (
    {_count('line', '[#*$%&<>]')} * 100 > n * 30 OR {_count('line', '[|»]')} * 100 > n * 20 OR {_count('line', '!!')} * 100 > n * 30
    OR (n <= 30 AND ({_FURNITURE})) OR regexp_matches(line, '^[\x20\x09]*[{{}}\[\];]+[\x20\x09]*$')) AS fails
  FROM lines
),
by_doc AS (
  SELECT doc_id, count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS dup, count(*) FILTER (fails) AS cut,
    sum(chars) AS chars, coalesce(sum(chars) FILTER (fails), 0) AS lost
  FROM judged GROUP BY doc_id
),
base AS (
  SELECT d.doc_id, len(w) AS n_words, b.chars, {_count('text', '[#*$%&|<>]')} AS n_symbols, b.dup,
    coalesce(r.n, 0) AS repeat_words, b.cut, b.lost, len(w) < 50 OR 100 * coalesce(r.n, 0) > 50 * len(w) AS failed
  FROM d JOIN by_doc b USING (doc_id) LEFT JOIN repeated r USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, dup::BIGINT AS n_dup_lines,
  repeat_words::BIGINT AS n_repeat_words, failed AS base_failed, NOT failed AND NOT (lost * 100 > chars * 50) AS kept, cut::BIGINT AS n_lines_cut
FROM base
"""

OP3 = rf"""
WITH d AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i+19], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)
),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id),
gone AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(gone.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)
"""

OP5 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOWER.format('text'))} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * pairs.n >= 75 * (x.n + y.n - pairs.n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
component AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM component LEFT JOIN sizes USING (doc_id)
"""

OP7 = rf"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
),
keys AS (SELECT doc_id, line, pos, {_LOWER.format(f"trim(line, {_BLANK})")} AS k FROM lines),
common AS (
  SELECT k, max(doc_id) AS keeper FROM keys WHERE len(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
),
marked AS (SELECT doc_id, line, pos, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM keys LEFT JOIN common USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_TERMS = r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP10 = rf"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
items AS (SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, {_TERMS} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i+n-1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM items)),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i+n-1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
),
found AS (SELECT doc_id, i, n, item_id FROM places JOIN windows USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM found GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ORACLES = {
    "op1_quality_rules": OP1,
    "op3_substring_dedup": OP3,
    "op5_minhash_dedup": OP5,
    "op7_line_dedup": OP7,
    "op10_decontaminate": OP10,
}
