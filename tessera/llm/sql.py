"""DuckDB SQL of the corpus queries that SQL can express, over the same tables; each result is exact."""

#: Words of a lower-cased (A-Z) text, as a list.
_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

#: Sets (k, s) of two words or more in common, by prefixes in an order of rarity: pairs a < b of similarity 0.8 or more.
_SIMILAR = """
  each AS (SELECT k, unnest(s) AS w, len(s) AS n FROM sets WHERE len(s) > 0),
  freq AS (SELECT w, count(*) AS c FROM each GROUP BY w),
  ranked AS (SELECT k, w, n, row_number() OVER (PARTITION BY k ORDER BY c, w) AS pos FROM each JOIN freq USING (w)),
  firsts AS (SELECT * FROM ranked WHERE pos <= n - ceil(80 * n / 100.0) + 1),
  near AS (SELECT DISTINCT x.k AS a, y.k AS b FROM firsts x JOIN firsts y ON x.w = y.w AND x.k < y.k AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)),
  sized AS (SELECT a, b, len(x.s) + len(y.s) AS n, len(list_intersect(x.s, y.s)) AS common FROM near JOIN sets x ON x.k = a JOIN sets y ON y.k = b),
  links AS (SELECT a, b FROM sized WHERE 100 * common >= 80 * (n - common))
"""

LINES = f"""
WITH lines AS (
  SELECT doc_id, i, x[i] AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents), unnest(range(1, len(x) + 1)) AS u(i)
),
worded AS (SELECT doc_id, i, list_sort(list_distinct({_WORDS.format("line")})) AS s FROM lines),
placed AS (SELECT *, row_number() OVER (ORDER BY doc_id, i) AS p FROM worded WHERE len(s) > 0),
classed AS (SELECT doc_id, i, s, p, min(p) OVER (PARTITION BY s) AS k FROM placed),
sets AS (SELECT k, s FROM classed WHERE p = k),
{_SIMILAR},
gone AS (SELECT doc_id, i FROM classed WHERE p > k OR k IN (SELECT b FROM links)),
kept AS (SELECT l.*, g.i IS NOT NULL AS removed, w.i IS NOT NULL AS worded FROM lines l LEFT JOIN gone g USING (doc_id, i) LEFT JOIN placed w USING (doc_id, i)),
texts AS (
  SELECT doc_id, count(*) FILTER (worded) AS n_lines, count(*) FILTER (removed) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT removed), '') AS text FROM kept GROUP BY doc_id
)
SELECT doc_id, n_lines, n_removed, length(text) AS n_chars_kept, sha256(text) AS kept_sha256 FROM texts
"""

NEAR = f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
sets AS (
  SELECT doc_id AS k, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words
),
{_SIMILAR},
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM ways UNION SELECT r.a, e.b FROM reach r JOIN ways e ON r.b = e.a),
roots AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT k AS doc_id, len(s) AS n_shingles, least(k, coalesce(m, k)) AS component_id, k = least(k, coalesce(m, k)) AS kept FROM sets LEFT JOIN roots ON k = a
"""

PASSAGES = """
WITH raw AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS w FROM raw, unnest(range(0, greatest(len(h) // 2 - 199, 0))) AS u(i)),
many AS (SELECT w FROM starts GROUP BY w HAVING count(*) > 1),
found AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS last FROM starts SEMI JOIN many USING (w)),
marked AS (SELECT doc_id, i, sum(CASE WHEN last IS NULL OR i > last + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM found),
runs AS (SELECT doc_id, run, min(i) AS f, max(i) + 200 AS t FROM marked GROUP BY doc_id, run),
gaps AS (SELECT doc_id, run AS k, f, coalesce(lag(t) OVER (PARTITION BY doc_id ORDER BY run), 0) AS kept_from, t FROM runs),
pieces AS (
  SELECT doc_id, k, substr(h, 2 * kept_from + 1, 2 * (f - kept_from)) AS piece FROM gaps JOIN raw USING (doc_id)
  UNION ALL
  SELECT doc_id, 1099511627776, substr(h, 2 * coalesce(t, 0) + 1) FROM raw LEFT JOIN (SELECT doc_id, max(t) AS t FROM runs GROUP BY doc_id) USING (doc_id)
),
texts AS (SELECT doc_id, string_agg(piece, '' ORDER BY k) AS kept FROM pieces GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n_spans, sum(t - f) AS n_removed FROM runs GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM raw JOIN texts USING (doc_id) LEFT JOIN counts USING (doc_id)
"""
