"""SQL (DuckDB) that computes the whole results of the queries that SQL can express."""

from __future__ import annotations

import string

from .substring_dedup import WINDOW

_WORDS = r"coalesce(regexp_extract_all({text}, '[^\x20\x09-\x0D]+'), [])"
_FOLDED = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def _run_of(n: int) -> str:
    """The next ``n`` words of a document, joined; null where fewer are left. Words hold no space."""
    return " || ' ' || ".join(["word", *(f"lead(word, {k}) OVER w" for k in range(1, n))])


REPEATED_PASSAGES = f"""
WITH words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT doc_id, {_WORDS.format(text="text")} AS w FROM documents)),
windows AS (
  SELECT doc_id, pos, word, {_run_of(WINDOW)} AS win FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
told AS (
  SELECT doc_id, pos, word, win IS NOT NULL AND row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) > 1 AS later FROM windows),
covered AS (
  SELECT doc_id, pos, word, bool_or(later) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) AS gone FROM told),
cut AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone) AS kept
  FROM covered GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN cut USING (doc_id)
"""


def near_duplicates(shingle: int, percent: int) -> str:
    return f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, {_WORDS.format(text=_FOLDED)} AS w FROM documents),
words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM texts),
shingles AS (
  SELECT DISTINCT doc_id, s
  FROM (SELECT doc_id, {_run_of(shingle)} AS s FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
  WHERE s IS NOT NULL
  UNION ALL
  SELECT doc_id, array_to_string(w, ' ') FROM texts WHERE len(w) BETWEEN 1 AND {shingle - 1}),
sets AS (
  SELECT doc_id, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS name FROM shingles GROUP BY doc_id),
reps AS (
  SELECT name, min(doc_id) AS id, any_value(n) AS n FROM sets GROUP BY name),
held AS (
  SELECT id, n, s FROM reps JOIN shingles ON doc_id = id),
links AS (
  SELECT x.id AS a, y.id AS b FROM held x JOIN held y
  ON x.s = y.s AND x.id <> y.id AND 100 * x.n >= {percent} * y.n AND 100 * y.n >= {percent} * x.n
  GROUP BY x.id, y.id HAVING 100 * count(*) >= {percent} * (any_value(x.n) + any_value(y.n) - count(*))),
reached AS (
  SELECT id, id AS found FROM reps
  UNION
  SELECT r.id, b FROM reached r JOIN links ON found = a),
components AS (
  SELECT id, min(found) AS component_id FROM reached GROUP BY id)
SELECT d.doc_id, coalesce(sets.n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id, coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sets USING (doc_id) LEFT JOIN reps USING (name) LEFT JOIN components USING (id)
"""
