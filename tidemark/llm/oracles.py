"""The same results in SQL, where SQL can express them and is fast enough on whole tables."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"coalesce(regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+'), [])"
_WORDS = rf"coalesce(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), [])"

OP9 = f"""
WITH i AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
starts AS (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM i WHERE len(w) > 0),
wanted AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, n, array_to_string(w[s:s + n - 1], ' ') AS k FROM starts),
lengths AS (SELECT DISTINCT n FROM wanted),
d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d CROSS JOIN lengths WHERE len(w) >= n),
windows AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS k FROM places),
hits AS (SELECT DISTINCT doc_id, s, windows.n AS n, item_id FROM windows JOIN wanted ON windows.n = wanted.n AND windows.k = wanted.k),
spots AS (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM spots GROUP BY doc_id),
items AS (SELECT DISTINCT doc_id, item_id FROM hits),
named AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS digest FROM items GROUP BY doc_id)
SELECT d.doc_id AS doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
       coalesce(t.digest, sha256('')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN covered c ON d.doc_id = c.doc_id LEFT JOIN named t ON d.doc_id = t.doc_id
"""

OP6 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS s FROM d WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[s:s + 1], ' ') AS x FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
),
links AS (
  SELECT c.a AS a, c.b AS b FROM common c JOIN sizes x ON c.a = x.doc_id JOIN sizes y ON c.b = y.doc_id
  WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)
),
both_ways AS (SELECT a, b FROM links UNION SELECT b AS a, a AS b FROM links),
reached AS (
  SELECT doc_id AS node, doc_id AS label FROM d
  UNION
  SELECT e.b AS node, r.label AS label FROM reached r JOIN both_ways e ON r.node = e.a WHERE r.label < e.b
),
least AS (SELECT node, min(label) AS label FROM reached GROUP BY node)
SELECT d.doc_id AS doc_id, coalesce(s.n, 0) AS n_shingles, l.label AS component_id, d.doc_id = l.label AS kept
FROM d LEFT JOIN sizes s ON d.doc_id = s.doc_id JOIN least l ON d.doc_id = l.node
"""

OP11 = r"""
WITH least AS (SELECT coalesce(text, '') AS t, min(doc_id) AS k FROM documents GROUP BY 1),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
fails AS (
  SELECT w.part AS part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
         CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * (length(w.t) - length(regexp_replace(w.t, '[A-Z]', '', 'g'))) > 3 * length(w.t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(w.t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN w.doc_id > l.k THEN 'E' ELSE '' END AS f
  FROM w JOIN least l ON w.t = l.t LEFT JOIN marks m ON w.doc_id = m.doc_id
),
masks AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, f),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
steps AS (SELECT o, s, substr(o, s, 1) AS letter, string_split(left(o, s - 1), '') AS before FROM orders, (SELECT unnest(range(1, 6)) AS s)),
fate AS (
  SELECT f, o, s, letter, contains(f, letter) AS failed, len(list_intersect(string_split(f, ''), before)) > 0 AND s > 1 AND f <> '' AS late
  FROM (SELECT DISTINCT f FROM masks), steps
),
counted AS (
  SELECT part, o, s, letter,
         sum(CASE WHEN NOT failed AND NOT late THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN failed AND NOT late THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN failed AND late THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fate.f = letter THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN failed AND NOT late THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN failed AND NOT late THEN toxic ELSE 0 END) AS toxic_lost
  FROM masks JOIN fate ON masks.f = fate.f GROUP BY part, o, s, letter
)
SELECT part, o AS filter_order, CAST(s AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""


def _op12(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Every part against every entry, once per round."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
a{k} AS MATERIALIZED (
  SELECT p.row AS row, p.pos AS pos, any_value(p.part) AS part,
         min({{'d': list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(p.part, c.entry)]), 'e': c.e}}) AS best
  FROM p JOIN c{k} c ON p.pos = c.pos GROUP BY p.row, p.pos
),
s{k} AS (SELECT pos, best.e AS e, i, sum(part[i]) AS s, count(*) AS n FROM a{k}, (SELECT unnest(range(1, (SELECT max(len(part)) FROM p) + 1)) AS i) GROUP BY 1, 2, 3),
n{k} AS (SELECT pos, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS entry FROM s{k} GROUP BY pos, e),
c{k + 1} AS MATERIALIZED (SELECT c.pos AS pos, c.e AS e, coalesce(n.entry, c.entry) AS entry FROM c{k} c LEFT JOIN n{k} n ON c.pos = n.pos AND c.e = n.e)""")
    return f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label, [CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS w
  FROM embeddings
  WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
p AS MATERIALIZED (
  SELECT row, vec_id, pos, w[pos * (len(w) // {parts}) + 1 : (pos + 1) * (len(w) // {parts})] AS part
  FROM v, (SELECT unnest(range({parts})) AS pos)
),
ids AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM (SELECT DISTINCT vec_id FROM v)),
c0 AS MATERIALIZED (SELECT p.pos AS pos, ids.e AS e, p.part AS entry FROM p JOIN ids ON p.vec_id = ids.vec_id WHERE ids.e < {entries}),
{",".join(steps)},
book AS (SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY pos, e)) AS digest FROM c{rounds}),
coded AS (
  SELECT row, string_agg(printf('%02x', best.e), '' ORDER BY pos) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY row
)
SELECT v.vec_id AS vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
FROM v JOIN coded ON v.row = coded.row, book
"""


OP13 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
e AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) AS chars,
         length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) AS role_chars,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS last_role
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       CAST(sum(chars + CASE WHEN role = last_role THEN 3 ELSE role_chars + 19 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

ORACLES = {
    "op6_bayesian_minhash": OP6,
    "op9_winnowing_decontamination": OP9,
    "op11_lehmer_filter_audit": OP11,
    "op12_hilbert_vector_codes": _op12(),
    "op13_relational_chats": OP13,
}
