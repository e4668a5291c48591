"""SQL of the numbered operators that it can express, for DuckDB."""

OP11_SQL = r"""
WITH RECURSIVE rules(host, path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), rest AS (
  SELECT page_id, url, html, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, html,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) AS query
  FROM rest
), named AS (
  SELECT *, CASE WHEN host <> '' THEN host || CASE WHEN path = '' THEN '/' ELSE path END || query END AS name FROM parts
), links AS (
  SELECT name AS a, unnest(regexp_extract_all(html, '<link rel="canonical" href="https?://([^"#]*)', 1)) AS b FROM named WHERE name IS NOT NULL
), edges AS (
  SELECT a, b FROM links WHERE a <> b UNION SELECT b, a FROM links WHERE a <> b
), reach(a, b) AS (
  SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a
), spots AS (
  SELECT host, path, name FROM named
  UNION SELECT regexp_extract(b, '^[^/?]*'), regexp_extract(b, '^[^/?]*([^?]*)', 1), b FROM edges
), fits AS (
  SELECT s.name, s.host, s.path, max_by(r.host || r.path, length(r.host || r.path)) AS rule, max_by(r.verdict, length(r.host || r.path)) AS verdict
  FROM (SELECT DISTINCT host, path, name FROM spots) s
  JOIN rules r ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path) GROUP BY ALL
), said AS (
  SELECT r.a AS name, CASE WHEN bool_or(f.verdict = 'allow') THEN 'allow' ELSE 'block' END AS verdict
  FROM reach r JOIN fits f ON f.name = r.b GROUP BY r.a
)
SELECT n.page_id, n.host, n.path, f.rule, coalesce(f.verdict, s.verdict, 'allow') AS verdict
FROM named n LEFT JOIN fits f ON n.name = f.name AND n.host = f.host AND n.path = f.path LEFT JOIN said s ON n.name = s.name
"""

OP12_SQL = r"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, list({'r': r, 't': t} ORDER BY p) AS own,
    xor(list_reduce(list_transform(string_split(c::VARCHAR, ''), lambda s: ord(s)::BIGINT), lambda crc, byte:
      list_reduce([1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[], lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, byte)),
      4294967295), 4294967295) % 4 AS h
  FROM turns GROUP BY c
), built AS (
  SELECT a.c, list_concat(coalesce(b.own[1:a.h], []), a.own[a.h + 1:]) AS said FROM convs a LEFT JOIN convs b ON b.c = a.c - a.c % 20
), steps AS (
  SELECT c, said, unnest(range(0, len(said) + 1)) AS d FROM built
), nodes AS (
  SELECT said[1:d] AS prefix, d AS depth, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CASE WHEN len(said) = d THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends_sha256
  FROM steps GROUP BY ALL
), up AS (
  SELECT *, CASE WHEN depth > 0 THEN prefix[1:depth - 1] END AS parent,
    CASE WHEN depth > 0 THEN (n_convs - 1) * len(regexp_extract_all(prefix[depth].t, '[^\x20\x09-\x0D]+')) ELSE 0 END AS saved
  FROM nodes
), kids AS (
  SELECT parent AS prefix, count(*) AS n_children FROM up WHERE depth > 0 GROUP BY parent
), counted AS (
  SELECT u.*, coalesce(n_children, 0) AS n_children FROM up u LEFT JOIN kids k ON u.prefix = k.prefix
), sums AS (
  SELECT prefix[1:k] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM counted) GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM counted n JOIN sums s ON n.prefix = s.prefix LEFT JOIN counted p ON n.parent = p.prefix
"""

OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), numbered AS (
  SELECT lang, row_number() OVER () AS piece, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
), words AS (
  SELECT lang, piece, unnest(w) AS a, unnest(range(1, len(w) + 1)) AS i FROM numbered
), places AS (
  SELECT lang, a, lead(a) OVER o AS b, lead(a, 2) OVER o AS c FROM words WINDOW o AS (PARTITION BY piece ORDER BY i)
), grams AS (
  SELECT lang, 1 AS k, [a] AS g, count(*) AS n FROM places GROUP BY ALL
  UNION ALL SELECT lang, 2, [a, b], count(*) FROM places WHERE b IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
  UNION ALL SELECT lang, 3, [a, b, c], count(*) FROM places WHERE c IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), totals AS (
  SELECT lang, sum(n)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k, g, n AS a FROM grams WHERE k > 1 AND n >= 10
), cuts AS (
  SELECT c.lang, c.g, c.a, x.n AS l, y.n AS r, p.cut, (1000000::HUGEINT * c.a * c.a // (x.n::HUGEINT * y.n))::BIGINT AS score
  FROM candidates c JOIN (VALUES (1), (2)) AS p(cut) ON p.cut < c.k
  JOIN grams x ON x.lang = c.lang AND x.g = c.g[1:p.cut] JOIN grams y ON y.lang = c.lang AND y.g = c.g[p.cut + 1:]
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, g, max(a) AS longer FROM (SELECT lang, unnest([g[1:2], g[2:3]]) AS g, a FROM candidates WHERE k = 3) GROUP BY ALL
), ranked AS (
  SELECT b.*, array_to_string(b.g, ' ') AS phrase FROM best b LEFT JOIN inside i ON b.lang = i.lang AND b.g = i.g WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.a
)
SELECT r.lang, row_number() OVER (PARTITION BY r.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r.r, t.n, score
FROM ranked r JOIN totals t ON r.lang = t.lang QUALIFY rank <= 2000
"""
