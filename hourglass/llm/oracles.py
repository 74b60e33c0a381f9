"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from hourglass.llm.license_scan import PHRASES, TEMPLATES

WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP2 = f"""
WITH items AS (SELECT item_id, {WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS g
  FROM items, unnest(generate_series(1, greatest(1, len(w) - 9))) AS u(s) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM windows),
docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
places AS (
  SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS g
  FROM docs, lengths, unnest(generate_series(1, len(w) - n + 1)) AS u(s)),
found AS (SELECT doc_id, item_id, p.n, s FROM places p JOIN windows w ON p.n = w.n AND p.g = w.g),
hit AS (SELECT doc_id, count(DISTINCT s + k) AS n_hit FROM found, unnest(generate_series(0, n - 1)) AS u(k) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP3 = """
WITH whole AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def _rows(pairs) -> str:
    return ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in pair)) for pair in pairs)


OP1 = f"""
WITH phrases(phrase, label) AS (VALUES {_rows(PHRASES.items())}),
templates AS (
  SELECT row_number() OVER () AS t, label, len({WORDS}) AS n, list_distinct({WORDS}) AS w FROM (VALUES {_rows(TEMPLATES)}) AS v(label, text)),
near AS (
  SELECT a.t, list_filter(a.w, lambda x: NOT list_contains(b.w, x)) AS own, list_filter(b.w, lambda x: NOT list_contains(a.w, x)) AS other
  FROM templates a JOIN templates b ON a.label <> b.label AND 10 * len(list_intersect(a.w, b.w)) >= 8 * len(a.w)),
docs AS (SELECT row_number() OVER () AS r, doc_id, text, {WORDS} AS w FROM documents),
base AS (
  SELECT r, s - 1 AS place, label FROM docs, phrases, unnest(generate_series(1, len(w))) AS u(s)
  WHERE array_to_string(w[s : s + len(string_split(phrase, ' ')) - 1], ' ') = phrase),
lines AS (SELECT r, unnest(string_split(coalesce(text, ''), chr(10))) AS text FROM docs),
blocks AS (SELECT r, {WORDS} AS w FROM lines),
whole AS (
  SELECT r, t, n, label, blocks.w AS line, templates.w AS tw FROM blocks, templates
  WHERE 10 * len(list_intersect(blocks.w, templates.w)) >= 8 * len(templates.w)),
windows AS (
  SELECT r, t, label, tw, line[s : s + 2 * n - 1] AS w FROM whole, unnest(generate_series(1, greatest(1, len(line) - 2 * n + 1))) AS u(s)),
met AS (
  SELECT r, label, len(list_intersect(w, tw)) AS shared, len(tw) AS size FROM windows
  WHERE 10 * shared >= 8 * size AND NOT EXISTS (
    SELECT 1 FROM near WHERE near.t = windows.t AND CASE
      WHEN len(own) > 0 THEN len(list_intersect(own, w)) < len(own)
      ELSE len(other) > 0 AND len(list_intersect(other, w)) = len(other) END)),
base_by AS (
  SELECT r, count(*) AS n, min(place) AS first_word, max(place) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM base GROUP BY r),
all_by AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT r, label FROM base UNION SELECT r, label FROM met) GROUP BY r),
met_by AS (SELECT r, max(shared / size) AS score FROM met GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(b.labels, '') AS base_labels, coalesce(a.labels, '') AS labels,
  CAST(CASE WHEN b.n > 0 THEN 1 ELSE coalesce(m.score, 0) END AS DOUBLE) AS score
FROM docs LEFT JOIN base_by b USING (r) LEFT JOIN all_by a USING (r) LEFT JOIN met_by m USING (r)
"""

OP4 = """
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[s : s + least(len(w), 3) - 1], ' ') AS g
  FROM docs, unnest(generate_series(1, greatest(1, len(w) - 2))) AS u(s) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM pairs p JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * p.n >= 85 * (x.n + y.n - p.n)),
reach AS (SELECT doc_id, doc_id AS other FROM docs UNION SELECT reach.doc_id, b FROM reach JOIN links ON a = other),
least_of AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, component_id = doc_id AS kept
FROM least_of LEFT JOIN sizes USING (doc_id)
"""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    regexp_extract_all(unnest(regexp_split_to_array({LOWER}, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w FROM documents),
places AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS s FROM pieces),
grams AS (
  SELECT lang, m, w[s : s + m - 1] AS p FROM places, unnest(generate_series(1, 5)) AS u(m) WHERE s + m - 1 <= len(w)),
counted AS (SELECT lang, m, p, array_to_string(p, ' ') AS phrase, count(*) AS f FROM grams GROUP BY lang, m, p),
totals AS (SELECT lang, sum(f) AS n FROM counted WHERE m = 1 GROUP BY lang),
often AS (SELECT * FROM counted WHERE f >= 100),
inside AS (
  SELECT lang, array_to_string(p[s : s + k - 1], ' ') AS phrase, max(f) AS most
  FROM often, unnest(generate_series(2, 4)) AS a(k), unnest(generate_series(1, 4)) AS b(s)
  WHERE k < m AND s + k - 1 <= m GROUP BY 1, 2),
open AS (
  SELECT often.* FROM often LEFT JOIN inside USING (lang, phrase) WHERE m > 1 AND (most IS NULL OR 100 * most < 100 * f)),
cuts AS (
  SELECT o.lang, o.phrase, o.f AS a, k, x.f AS l, y.f AS r, n,
    (1000::HUGEINT * o.f * n) // (x.f::HUGEINT * y.f) AS score
  FROM open o JOIN totals USING (lang), unnest(generate_series(1, 4)) AS u(k), often x, often y
  WHERE k < o.m AND x.lang = o.lang AND x.phrase = array_to_string(o.p[1 : k], ' ')
    AND y.lang = o.lang AND y.phrase = array_to_string(o.p[k + 1 : o.m], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""

OP12 = """
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (
  SELECT *, len(u) AS n, CAST('0x' || h[1 : 8] AS BIGINT) % (len(u) + 1) AS h1, CAST('0x' || h[9 : 16] AS BIGINT) % (len(u) + 1) AS h2,
    CAST('0x' || h[17 : 24] AS BIGINT) % 100 AS h3, CAST('0x' || h[25 : 32] AS BIGINT) % 100 AS h4 FROM docs),
formed AS (
  SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
                 WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(u[1 : least(h1, h2)], '') AS p, array_to_string(u[least(h1, h2) + 1 : greatest(h1, h2)], '') AS m,
    array_to_string(u[greatest(h1, h2) + 1 : n], '') AS s FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM formed
"""

ORACLES = {"op1_license_scan": OP1, "op4_near_dedup": OP4, "op2_benchmark_decontamination": OP2, "op3_exact_top_k": OP3,
           "op11_phrase_collocations": OP11, "op12_fill_in_middle": OP12}
