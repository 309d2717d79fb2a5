"""DuckDB SQL for the corpus queries that SQL can express: op4, op6 and op10.

op1 is a trained model, op2 and op9 need hash functions that DuckDB lacks, op3 and op5 need hashed seeds and placed matches, op7 and op8
a vocabulary file; tests hold these against plain versions.
"""

from __future__ import annotations

from . import license, substring

WORD = r"[^\x20\x09-\x0D]+"


def op4(length: int = substring.LENGTH) -> str:
    return f"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
win AS (SELECT doc_id, s, array_to_string(w[s : s + {length - 1}], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - {length - 2})) AS s FROM d WHERE len(w) >= {length})),
rep AS (SELECT doc_id, s FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM win) WHERE n > 1),
pos AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM d),
cov AS (SELECT p.doc_id, p.i, p.x, max(r.s) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN {length - 1} PRECEDING AND CURRENT ROW) IS NOT NULL AS gone FROM pos p LEFT JOIN rep r ON r.doc_id = p.doc_id AND r.s = p.i),
res AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(x, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM cov GROUP BY 1)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN res USING (doc_id)"""


def op6() -> str:
    return f"""WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS n FROM g) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM r, range(5) q(o) GROUP BY 1),
l AS (SELECT * FROM (SELECT doc_id, host, t, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{WORD}')),
ln AS (SELECT *, lower(trim(regexp_replace(line, '[\\x20\\x09-\\x0D]+', ' ', 'g'))) AS norm FROM l),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM l GROUP BY 1),
texts AS (SELECT host, count(DISTINCT t) AS n FROM d GROUP BY 1),
common AS (
  SELECT c.host, c.norm FROM (SELECT host, norm, count(DISTINCT t) AS n FROM ln GROUP BY 1, 2) c JOIN texts x ON x.host IS NOT DISTINCT FROM c.host
  WHERE c.n >= greatest(5.0, least(100.0, 0.02 * x.n))),
gone AS (SELECT doc_id, sum(len(string_split(ln.norm, ' '))) AS n FROM ln JOIN common ON ln.host IS NOT DISTINCT FROM common.host AND ln.norm = common.norm GROUP BY 1),
f AS (
  SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(w) - coalesce(gone.n, 0) AS n_left
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_left > 0 AND n_left >= 0.6 * n_words AS kept FROM f"""


def op10() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    listed = ", ".join(f"({i}, {quote(k)}, {quote(v)})" for i, (k, v) in enumerate(sorted(license.TEMPLATES.items())))
    return f"""WITH raw(rank, license, t) AS (VALUES {listed}),
tw AS (SELECT rank, license, regexp_extract_all(lower(t), '[\\p{{L}}\\p{{N}}]+') AS w FROM raw),
tpl AS (SELECT rank, license, grams, ceil(len(grams) * 0.8 / 1.2 - 1e-9) AS low, floor(len(grams) * 1.2 / 0.8 + 1e-9) AS high
  FROM (SELECT rank, license, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS grams FROM tw)),
lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS u, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
cut AS (SELECT doc_id, i, regexp_extract_all(lower(u), '[\\p{{L}}\\p{{N}}]+') AS w FROM lines),
runs AS MATERIALIZED (SELECT doc_id, i, len(w) AS n, sum(len(w)) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM cut WHERE len(w) > 0),
d AS MATERIALIZED (SELECT doc_id, w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS g
  FROM (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents)),
units AS (SELECT a.doc_id, a.upto - a.n AS first, b.upto - (a.upto - a.n) - 1 AS n FROM runs a JOIN runs b
  ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - (a.upto - a.n) - 1 BETWEEN (SELECT min(low) FROM tpl) AND (SELECT max(high) FROM tpl)),
may AS (SELECT d.doc_id, t.rank, t.license, t.grams, t.low, t.high, d.g FROM d JOIN tpl t ON len(list_intersect(d.g, t.grams)) >= t.low),
found AS (SELECT doc_id, rank, license, 2.0 * len(list_intersect(u, grams)) / (len(u) + len(grams)) AS dice
  FROM (SELECT m.doc_id, rank, license, grams, list_distinct(g[first + 1 : first + n]) AS u FROM may m JOIN units USING (doc_id) WHERE n BETWEEN low AND high)),
best AS (SELECT doc_id, max(dice) AS dice, count(DISTINCT license) AS n FROM found WHERE dice >= 0.8 GROUP BY 1),
top AS (SELECT doc_id, license FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, rank) AS m FROM found WHERE dice >= 0.8) WHERE m = 1)
SELECT documents.doc_id, license, coalesce(dice, 0.0) AS dice, coalesce(n, 0) AS n_licenses FROM documents LEFT JOIN best USING (doc_id) LEFT JOIN top USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {"op4_substring_repeats": op4(), "op6_quality_rules": op6(), "op10_license_scan": op10()}
