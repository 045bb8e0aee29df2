"""SQL for DuckDB that the queries must agree with, for the operators that SQL can express."""

OP1 = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), ok AS (
  SELECT * FROM v
  WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND list_inner_product(e, e) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.9
), reach AS (
  SELECT vec_id AS id, vec_id AS root FROM v
  UNION
  SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.id
)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE links.a = v.vec_id) AS n_links,
       min(root) AS component_id, v.vec_id = min(root) AS kept
FROM v JOIN reach ON reach.id = v.vec_id GROUP BY v.vec_id
"""

OP2 = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY list_slice(words, i, i + 19) ORDER BY doc_id, i) > 1 AS later
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM w WHERE len(words) >= 20)
), places AS (
  SELECT doc_id, words[j] AS word, j FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS j FROM w)
), judged AS (
  SELECT p.doc_id, p.word, p.j,
         coalesce(max(CASE WHEN later THEN p.j END)
                  OVER (PARTITION BY p.doc_id ORDER BY p.j ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0) > 0 AS gone
  FROM places p LEFT JOIN windows x ON x.doc_id = p.doc_id AND x.i = p.j
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN (
  SELECT doc_id, count(*) FILTER (gone) AS n, string_agg(word, ' ' ORDER BY j) FILTER (NOT gone) AS kept
  FROM judged GROUP BY doc_id
) USING (doc_id)
"""

OP6 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 1 THEN [words[1]]
         ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS g
  FROM w WHERE len(words) > 0
), n AS (
  SELECT w.doc_id, count(g) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id
), links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
    GROUP BY x.doc_id, y.doc_id
  ) JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * common >= 80 * (na.n + nb.n - common)
), reach AS (
  SELECT doc_id AS id, doc_id AS root FROM w
  UNION
  SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.id
)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(root) AS component_id, n.doc_id = min(root) AS kept
FROM n JOIN reach ON reach.id = n.doc_id GROUP BY n.doc_id, n.n
"""

OP8 = r"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS url,
         translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 2) AS path,
         regexp_extract(coalesce(url, ''), '^[^?#]*\?([^#]*)', 1) AS query
  FROM pages
), spelled AS (
  SELECT *, CASE WHEN host = '' THEN NULL ELSE regexp_replace(
           regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '/+$', '') || '?' ||
           array_to_string(list_sort(list_filter(string_split(query, '&'),
             lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|gclid|fbclid)(=|$)'))), '&'), '\?$', '') END AS canonical
  FROM parts
), listed AS (
  SELECT DISTINCT canonical FROM spelled
  WHERE regexp_matches(host, '^([^.]*\.)?[a-z0-9]*(spam|cheap|casino|pills|free)[a-z0-9]*-[a-z0-9-]*\.')
), ruled AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM spelled
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN canonical IN (SELECT canonical FROM listed WHERE canonical IS NOT NULL) THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""

OP10 = r"""
WITH sized AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY key ORDER BY CAST(floor(4 * sqrt(CAST(size AS DOUBLE))) AS BIGINT),
      CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 64, doc_id, size) AS r
  FROM sized
), sources AS (
  SELECT key, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM sized GROUP BY key, source
), levels AS (
  SELECT *, CAST((sum(source_size) OVER ()) - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
         / CAST(sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM sources WINDOW o AS (ORDER BY CAST(3 * source_size AS DOUBLE) / w, key)
), targets AS (
  SELECT key, source_size, least(CAST(3 * source_size AS DOUBLE), w * max(level) OVER ()) AS target,
         CAST('0x' || substr(md5('mix' || key), 1, 5) AS BIGINT) / CAST(1048576 AS DOUBLE) AS u
  FROM levels
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets
)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate * r + u) - floor(rate * (r - 1) + u)) AS BIGINT) AS taken
FROM ranked JOIN rates USING (key)
"""

OP12 = """
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || left(t, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
                        WHEN 'spm' THEN '<S>' || substr(t, b + 1) || '<P>' || left(t, a) || '<M>' || substr(t, a + 1, b - a)
                        ELSE t END) AS output_sha256, sha256(t) AS restored_sha256
FROM (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
      FROM (SELECT doc_id, t, length(t) AS n, ('0x' || substr(s, 1, 8))::BIGINT AS h1, ('0x' || substr(s, 9, 8))::BIGINT AS h2,
                   ('0x' || substr(s, 17, 8))::BIGINT AS h3, ('0x' || substr(s, 25, 8))::BIGINT AS h4
            FROM (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS s FROM documents)))
"""

# The checksum is the common CRC-32, byte by byte over the UTF-8 of the key and the word, by a table made from its rule.
OP13 = r"""
WITH RECURSIVE crc(i, c, step) AS (
    SELECT i, CAST(i AS BIGINT), 0 FROM range(256) r(i)
    UNION ALL
    SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM crc WHERE step < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc WHERE step = 8),
runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents) GROUP BY ALL),
hashed AS (
    SELECT run, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda x:
               CASE WHEN ord(x) < 128 THEN [CAST(ord(x) AS BIGINT)] ELSE [CAST(192 + (ord(x) >> 6) AS BIGINT), 128 + (ord(x) & 63)] END))),
               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
    FROM runs, crc_table),
words AS (
    SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
    FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5),
gaps AS (
    SELECT word, n, length(word) AS l, i, left(word, i) || substr(word, i + 2) AS gap
    FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b USING (gap, l, i) WHERE a.word <> b.word
    UNION
    SELECT a.word, b.word, b.n FROM words a JOIN gaps b ON b.gap = a.word
    UNION
    SELECT b.word, a.word, a.n FROM words a JOIN gaps b ON b.gap = a.word),
best AS (
    SELECT word, count(*) AS n_near, max(other_n) AS other_n, arg_min(other, (-other_n, other)) AS other FROM near GROUP BY word),
forms AS (
    SELECT w.word, CASE WHEN b.other_n >= 5 * w.n THEN b.other END AS form, w.n, coalesce(b.n_near, 0) AS n_near,
           CASE WHEN b.other_n >= 5 * w.n THEN b.other_n END AS form_n
    FROM words w LEFT JOIN best b ON b.word = w.word),
chain(word, spot) AS (
    SELECT word, form FROM forms WHERE form IS NOT NULL
    UNION ALL
    SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.spot WHERE f.form IS NOT NULL),
last AS (SELECT c.word, c.spot FROM chain c JOIN forms f ON f.word = c.spot WHERE f.form IS NULL)
SELECT f.word, f.form, coalesce(l.spot, f.word) AS root, f.n, f.n_near, f.form_n FROM forms f LEFT JOIN last l ON l.word = f.word
"""

ORACLE = {
    "op1_vectors": OP1,
    "op2_substrings": OP2,
    "op6_minhash": OP6,
    "op8_urls": OP8,
    "op10_mixing": OP10,
    "op12_fill_middle": OP12,
    "op13_spelling": OP13,
}
