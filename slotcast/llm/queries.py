"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from slotcast.llm.collocations import op13_collocations
from slotcast.llm.decontaminate import op4_templates
from slotcast.llm.fingerprints import op3_fingerprints
from slotcast.llm.hard_negatives import op12_hard_negatives
from slotcast.llm.html_text import op5_html_text
from slotcast.llm.language import op8_language
from slotcast.llm.licenses import op6_licenses
from slotcast.llm.near_dups import op9_minhash
from slotcast.llm.packing import op10_packing
from slotcast.llm.pii import op2_personal_data
from slotcast.llm.suffixes import op1_suffixes
from slotcast.llm.token_counts import op7_token_counts
from slotcast.llm.token_files import op11_token_files

QUERIES = {
    "op1_suffixes": op1_suffixes,
    "op2_personal_data": op2_personal_data,
    "op3_fingerprints": op3_fingerprints,
    "op4_templates": op4_templates,
    "op5_html_text": op5_html_text,
    "op6_licenses": op6_licenses,
    "op7_token_counts": op7_token_counts,
    "op8_language": op8_language,
    "op9_minhash": op9_minhash,
    "op10_packing": op10_packing,
    "op11_token_files": op11_token_files,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_collocations": op13_collocations,
}

#: Near-duplicates by brute force: all pairs of documents that share a shingle.
_NEAR_DUPLICATES = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(
    string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\\x20\\x09-\\x0D]+'),
    lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT doc_id, unnest(CASE
    WHEN len(ws) = 0 THEN []::VARCHAR[]
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))
  END) AS shingle
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i
  FROM s AS a JOIN s AS b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM pairs JOIN n AS nx ON nx.doc_id = x JOIN n AS ny ON ny.doc_id = y
  WHERE 100 * i >= 75 * (nx.n + ny.n - i)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT x AS doc_id, y AS other FROM edges
  UNION
  SELECT reach.doc_id, edges.y FROM reach JOIN edges ON reach.other = edges.x),
least AS (SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id)
SELECT
  d.doc_id,
  CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
  least(d.doc_id, coalesce(least.low, d.doc_id)) AS component_id,
  d.doc_id <= coalesce(least.low, d.doc_id) AS kept
FROM documents AS d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least ON least.doc_id = d.doc_id
"""

#: Collocations by counting every n-gram as text.
_COLLOCATIONS = """
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]') AS pieces
  FROM documents),
p AS (SELECT lang, list_filter(string_split_regex(unnest(pieces), '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM d),
g AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS a
  FROM (SELECT lang, k, ws, unnest(range(1, len(ws) - k + 2)) AS i FROM p, (SELECT unnest(range(1, 6)) AS k) WHERE len(ws) >= k)
  GROUP BY lang, k, phrase),
m AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang),
f AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, a FROM g WHERE a >= 100),
gone AS (
  SELECT lang, a, array_to_string(ws[1:k - 1], ' ') AS phrase FROM f WHERE k > 2
  UNION
  SELECT lang, a, array_to_string(ws[2:k], ' ') FROM f WHERE k > 2),
cuts AS (
  SELECT c.*, l.a AS l, r.a AS r,
    (CAST(1000 AS HUGEINT) * c.a * m.n) // (CAST(l.a AS HUGEINT) * r.a) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM f ANTI JOIN gone USING (lang, phrase, a) WHERE k > 1) AS c
  JOIN f AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:cut], ' ')
  JOIN f AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[cut + 1:c.k], ' ')
  JOIN m ON m.lang = c.lang),
least AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, m.n AS n, CAST(score AS BIGINT) AS score
FROM least JOIN m USING (lang)
QUALIFY rank <= 2000
"""

#: Hard negatives by all scores.
_HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""

#: The other operators learn, tokenize or parse in ways that SQL cannot express, or compare all
#: windows of all texts, which SQL is too slow for; tests hold them against brute force.
ORACLE: dict[str, str] = {"op9_minhash": _NEAR_DUPLICATES, "op12_hard_negatives": _HARD_NEGATIVES, "op13_collocations": _COLLOCATIONS}
