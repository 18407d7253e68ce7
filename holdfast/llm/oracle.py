"""DuckDB twins of the operators that SQL can express; the others are tested against plain Python."""

from __future__ import annotations

# Stripped at both ends of a line before it is compared.
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

VECTORS = """
known AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
"""

ORACLE: dict[str, str] = {
    "op2_topk": f"""
WITH {VECTORS},
whole AS (SELECT vec_id, list_transform(v, lambda x: floor(1024 * x)) AS v FROM known),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10""",
    "op3_vectors": f"""
WITH RECURSIVE {VECTORS},
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM known a JOIN known b ON a.vec_id <> b.vec_id
  WHERE len(a.v) = len(b.v) AND list_inner_product(a.v, a.v) > 0 AND list_inner_product(b.v, b.v) > 0
    AND list_inner_product(a.v, b.v) / sqrt(list_inner_product(a.v, a.v)) / sqrt(list_inner_product(b.v, b.v)) >= 0.9),
reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other),
smallest AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id),
counted AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN smallest USING (vec_id) LEFT JOIN counted USING (vec_id)""",
    "op6_minhash": """
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^ \t\n\v\f\r]+') AS w FROM documents WHERE doc_id IS NOT NULL),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle FROM worded),
sized AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM sets a JOIN sets b USING (shingle)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
  WHERE common >= 0.8::DOUBLE * (x.n + y.n - common)),
reached AS (
  SELECT doc_id, doc_id AS other FROM sized
  UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other),
smallest AS (SELECT doc_id, min(other) AS class_id FROM reached GROUP BY doc_id)
SELECT d.doc_id, class_id, d.doc_id = class_id AS kept FROM documents d LEFT JOIN smallest USING (doc_id)""",
    "op9_lines": f"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
placed AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM cut),
keyed AS (
  SELECT *, translate(trim(line, {BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM placed),
owned AS (SELECT *, length(key) >= 10 AND min(doc_id) OVER (PARTITION BY key) < doc_id AS gone FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM owned GROUP BY doc_id""",
    "op12_phrases": """
WITH plain AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\n-\r]')) AS piece FROM plain),
worded AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS words FROM pieces),
placed AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM worded),
sized AS (SELECT lang, words, i, unnest(range(1, 6)) AS m FROM placed),
counted AS (
  SELECT lang, m, array_to_string(words[i:i + m - 1], ' ') AS phrase, count(*) AS f
  FROM sized WHERE i + m - 1 <= len(words) GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE m = 1 GROUP BY lang),
candidates AS (SELECT * FROM counted WHERE m > 1 AND f >= 100),
cuts AS (
  SELECT lang, phrase, f, m, unnest(range(1, m)) AS k, string_split(phrase, ' ') AS words FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, n,
    ((1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN totals USING (lang)
  JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:k], ' ')
  JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[k + 1:], ' ')),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored),
inside AS (
  SELECT lang, f, unnest([array_to_string(words[1:m - 1], ' '), array_to_string(words[2:], ' '),
    array_to_string(words[1:m - 2], ' '), array_to_string(words[2:m - 1], ' '), array_to_string(words[3:], ' '),
    array_to_string(words[1:m - 3], ' '), array_to_string(words[2:m - 2], ' '), array_to_string(words[3:m - 1], ' '),
    array_to_string(words[4:], ' ')]) AS phrase
  FROM (SELECT *, string_split(phrase, ' ') AS words FROM candidates WHERE m > 2)),
around AS (SELECT lang, phrase, max(f) AS most FROM inside GROUP BY ALL),
kept AS (
  SELECT l.* FROM lowest l LEFT JOIN around USING (lang, phrase)
  WHERE place = 1 AND (most IS NULL OR 100 * most < 100 * a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000""",
    "op13_infill": """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units FROM documents),
drawn AS (
  SELECT *, len(units) AS n, list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(h, i, 8))::BIGINT) AS draws FROM cut),
placed AS (
  SELECT *, least(draws[1] % (n + 1), draws[2] % (n + 1)) AS one, greatest(draws[1] % (n + 1), draws[2] % (n + 1)) AS two,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR draws[3] % 100 >= 100
      THEN 'plain' WHEN draws[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT *, array_to_string(units[1:one], '') AS prefix, array_to_string(units[one + 1:two], '') AS middle,
    array_to_string(units[two + 1:], '') AS suffix FROM placed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts""",
}
