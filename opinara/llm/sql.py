"""DuckDB SQL of the queries that SQL can express."""

ORACLE = {}

ORACLE["op9_exact_dedup"] = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM t WINDOW same AS (PARTITION BY text)
"""

# Base 32 of a SHA-1: each five of its forty hex digits are four characters.
ORACLE["op4_warc"] = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
d AS (SELECT *, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS keeper FROM p),
b AS (SELECT *, list_transform(range(8), lambda i: ('0x' || h[5 * i + 1 : 5 * i + 5])::BIGINT) AS q
      FROM d)
SELECT page_id, strlen(html) AS payload_bytes,
       list_aggregate(flatten(list_transform(q, lambda x: list_transform(range(4), lambda k:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> (15 - 5 * k)) & 31)::INT + 1, 1)
       ))), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id < keeper THEN keeper END AS refers_to,
       coalesce(url, 'urn:x-page:' || page_id) AS url
FROM b
"""

ORACLE["op5_url_filter"] = r"""
WITH RECURSIVE
rules AS (SELECT *, split_part(rule, '/', 1) AS rule_host,
                 substr(rule, strpos(rule, '/')) AS rule_path FROM (VALUES
    ('allow', 'org/'), ('block', 'example.org/es/'), ('block', 'example.org/en/1'),
    ('allow', 'com/fr/'), ('block', 'com/de/')) AS v(verdict, rule)),
tags AS (SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag
         FROM pages),
found AS (SELECT url, regexp_matches(tag, '(?is)[\s"''/]rel\s*=\s*["'']?\s*canonical\b') AS link,
    regexp_matches(tag, '(?is)[\s"''/]http-equiv\s*=\s*["'']?\s*refresh\b') AS refresh,
    regexp_extract(tag, '(?is)[\s"''/]href\s*=\s*("[^"]*"|''[^'']*''|[^"''\s>]+)', 1) AS href,
    regexp_extract(tag, '(?is)[\s"''/]content\s*=\s*("[^"]*"|''[^'']*''|[^"''\s>]+)', 1) AS content
    FROM tags),
quoted AS (SELECT url, link, CASE WHEN link THEN href WHEN refresh THEN content END AS v FROM found),
bare AS (SELECT url, link, CASE WHEN v[1] IN ('"', '''') THEN v[2:-2] ELSE v END AS v FROM quoted),
plain AS (SELECT url, link, replace(replace(replace(replace(replace(replace(replace(v,
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&apos;', ''''), '&#39;', ''''), '&#38;', '&'),
    '&amp;', '&') AS v FROM bare),
aimed AS (SELECT url, CASE WHEN link THEN v ELSE regexp_replace(regexp_extract(
    v, '(?is)\burl\s*=\s*("[^"]*|''[^'']*|[^"''].*)', 1), '^["'']', '') END AS v FROM plain),
targets AS (SELECT url, regexp_replace(v, '^[\x09-\x0D ]+|[\x09-\x0D ]+$|[\t\r\n]', '', 'g') AS t,
    regexp_extract(url, '(?s)^.*?://[^/?#]*') AS site,
    coalesce(nullif(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), ''), '/') AS own FROM aimed),
joined AS (SELECT url AS source, CASE
    WHEN t = '' OR t[1] = '#' THEN NULL
    WHEN regexp_matches(t, '(?i)^[a-z][a-z0-9+.-]*://') THEN t
    WHEN regexp_matches(t, '(?i)^[a-z][a-z0-9+.-]*:') THEN NULL
    WHEN t[1:2] = '//' THEN 'http:' || t
    WHEN t[1] = '/' THEN site || t
    WHEN t[1] = '?' THEN site || own || t
    ELSE site || regexp_replace(own, '[^/]*$', '') || t END AS j FROM targets),
cut AS (SELECT source, j, regexp_extract(j, '(?s)^.*?://[^/?#]*') AS site,
    regexp_extract(j, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS way,
    regexp_extract(j, '(?s)^.*?://[^/?#]*[^?#]*(.*)$', 1) AS rest FROM joined WHERE j IS NOT NULL),
links AS (SELECT source, CASE WHEN regexp_matches(way, '/\.\.?(/|$)') THEN site
    || list_reduce(string_split(way, '/')[2:], lambda a, x: CASE x WHEN '.' THEN a
           WHEN '..' THEN regexp_replace(a, '/[^/]*$', '') ELSE a || '/' || x END, '')
    || CASE WHEN regexp_matches(way, '/\.\.?$') THEN '/' ELSE '' END || rest
    ELSE j END AS target FROM cut),
urls AS (SELECT url FROM pages UNION SELECT source FROM links UNION SELECT target FROM links),
parts AS (SELECT url, lower(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)) AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*[^?#]*(\?[^#]*)?', 1) AS query FROM urls),
nodes AS (SELECT *, nullif(host, '') || path || query AS node FROM parts),
fits AS (SELECT url, arg_max(rule, length(rule)) AS rule,
                arg_max(verdict, length(rule)) AS verdict
         FROM nodes, rules
         WHERE (host = rule_host OR ends_with(host, '.' || rule_host))
           AND starts_with(path, rule_path) GROUP BY url),
edges AS (SELECT a.node AS u, b.node AS v FROM links
          JOIN nodes a ON a.url = source JOIN nodes b ON b.url = target WHERE a.node <> b.node),
both_ways AS (SELECT u, v FROM edges UNION SELECT v, u FROM edges),
reach AS (SELECT u, v FROM both_ways
          UNION SELECT r.u, b.v FROM reach r JOIN both_ways b ON r.v = b.u),
classes AS (SELECT r.u AS node, min(f.verdict) AS verdict
            FROM reach r JOIN nodes n ON n.node = r.v JOIN fits f ON f.url = n.url GROUP BY r.u)
SELECT p.page_id, n.host, n.path, f.rule,
       coalesce(f.verdict, c.verdict, 'allow') AS verdict
FROM pages p JOIN nodes n ON n.url IS NOT DISTINCT FROM p.url
LEFT JOIN fits f ON f.url = p.url LEFT JOIN classes c ON c.node = n.node
"""
