"""DuckDB SQL of the operators on texts that SQL can express, over the driver's tables.

Each says the contract in its plainest form: every window, shingle or byte string is a row, equal ones
meet in a group or a join. Texts cut at fixed places only spare the string functions long arguments.
"""

FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACED = r"'[^\x20\x09-\x0D]+'"
WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

SUBSTRING_DEDUP = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(coalesce(text, ''), {SPACED}) AS w FROM documents),
s AS MATERIALIZED (
  SELECT doc, unnest(range(1, len(w) - 33)) AS i, unnest(list_transform(range(1, len(w) - 33), lambda i: array_to_string(w[i:i + 34], ' '))) AS words
  FROM d WHERE len(w) >= 35),
hit AS MATERIALIZED (
  SELECT DISTINCT doc, unnest(range(i, i + 35)) AS i FROM s WHERE words IN (SELECT words FROM s GROUP BY words HAVING count(*) > 1)),
each AS (SELECT doc, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
kept AS (SELECT doc, string_agg(word, ' ' ORDER BY i) AS kept FROM each ANTI JOIN hit USING (doc, i) GROUP BY doc),
gone AS (SELECT doc, count(*) AS n FROM hit GROUP BY doc)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc) LEFT JOIN kept USING (doc)
"""

DECONTAMINATION = f"""
WITH b AS MATERIALIZED (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({FOLDED}, {WORDS}) AS w FROM benchmark),
d AS MATERIALIZED (
  SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all({FOLDED}, {WORDS}) AS w FROM documents),
item_windows AS MATERIALIZED (
  SELECT DISTINCT item, least(len(w), 10) AS n,
    unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS words
  FROM b WHERE len(w) > 0),
doc_windows AS (
  SELECT doc, n, unnest(range(1, len(w) - n + 2)) AS i,
    unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS words
  FROM d, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n),
met AS MATERIALIZED (SELECT doc, d.n, i, item FROM doc_windows d JOIN item_windows USING (n, words)),
hit AS (SELECT doc, count(DISTINCT i) AS n_hit FROM (SELECT doc, unnest(range(i, i + n)) AS i FROM (SELECT DISTINCT doc, n, i FROM met)) GROUP BY doc),
items AS (SELECT doc, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc, item FROM met) GROUP BY doc)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc) LEFT JOIN items USING (doc)
"""

MINHASH_DEDUP = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({FOLDED}, {SPACED}) AS w
  FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) END AS s FROM d),
classes AS MATERIALIZED (SELECT min(doc_id) AS head, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
each AS MATERIALIZED (SELECT head, n, unnest(s) AS shingle FROM classes),
links AS MATERIALIZED (
  SELECT a.head AS a, b.head AS b FROM each a JOIN each b USING (shingle)
  WHERE a.head <> b.head AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.head, b.head, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT head AS a, head AS b FROM classes UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_ AS MATERIALIZED (SELECT a AS head, min(b) AS component FROM reach GROUP BY a),
found AS (
  SELECT doc_id, len(sets.s) AS n_shingles, coalesce(component, doc_id) AS component_id
  FROM sets LEFT JOIN classes ON sets.s = classes.s LEFT JOIN least_ USING (head))
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM found
"""

SUFFIX_DEDUP = """
WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, len(hex(encode(coalesce(text, '')))) // 2 AS n FROM documents),
blocks AS (SELECT doc_id, base, substr(x, 2 * base + 1, 1198) AS x, least(500, n - 99 - base) AS m
  FROM (SELECT *, unnest(range(0, n - 99, 500)) AS base FROM d)),
s AS MATERIALIZED (
  SELECT doc_id, base + unnest(range(0, m)) AS i, unnest(list_transform(range(0, m), lambda i: md5_number(substr(x, 2 * i + 1, 200)))) AS bytes
  FROM blocks),
firsts AS MATERIALIZED (SELECT bytes, min({'d': doc_id, 'i': i}) AS f FROM s GROUP BY bytes HAVING count(*) > 1),
again AS (SELECT doc_id, i FROM s JOIN firsts USING (bytes) WHERE {'d': doc_id, 'i': i} <> f),
marked AS (SELECT *, i > coalesce(lag(i) OVER w, -200) + 100 AS opens FROM again WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
runs AS MATERIALIZED (
  SELECT doc_id, run, min(i) AS lo, max(i) + 100 AS hi
  FROM (SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked) GROUP BY doc_id, run),
before AS (SELECT doc_id, lo, lag(hi, 1, 0) OVER (PARTITION BY doc_id ORDER BY lo) AS since FROM runs),
total AS (SELECT doc_id, count(*) AS n_spans, sum(hi - lo) AS n_removed, max(hi) AS last FROM runs GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(x, 2 * since + 1, 2 * (lo - since)), '' ORDER BY lo) AS kept FROM before JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept || substr(x, 2 * last + 1), x))) AS kept_sha256
FROM d LEFT JOIN total USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
