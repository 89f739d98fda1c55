"""DuckDB SQL for the results that SQL can express over whole tables."""

from __future__ import annotations

from . import op9_licenses

ORACLE: dict[str, str] = {}

# The rule thresholds repeat the operator's documented values on purpose: the
# SQL is written from the contract, not from the Spark code.
ORACLE["op2_quality_rules"] = r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents),
words AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM base),
grams AS (
  SELECT doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g, i
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)),
twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
m AS (
  SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(len(ls) AS BIGINT) AS n_lines,
         CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(regexp_extract_all(t, '!!')) AS BIGINT) AS n_bangs
  FROM words LEFT JOIN repeats USING (doc_id)),
b AS (
  SELECT *, CAST(CASE WHEN n_words < 50 THEN 1 ELSE 0 END
       + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
       + CASE WHEN 100 * n_symbols > 30 * n_words THEN 4 ELSE 0 END
       + CASE WHEN n_dup_lines >= 3 AND 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
       + CASE WHEN word_chars > 25 * n_words THEN 16 ELSE 0 END
       + CASE WHEN 100 * n_bangs > 30 * n_words THEN 32 ELSE 0 END AS BIGINT) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM b
"""

_LOWER_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

ORACLE["op7_benchmark_decontamination"] = rf"""
WITH items AS (
  SELECT item_id, {_LOWER_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)),
d AS (SELECT doc_id, {_LOWER_WORDS} AS w FROM documents),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
h AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
cover AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM h)) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover ON d.doc_id = cover.doc_id LEFT JOIN its ON d.doc_id = its.doc_id
"""

# The templates are data that both sides read; the alignment is a table of cells that a recursive
# query fills, one template word a step (cell 4 * e + x: ends before word e, holds x other words).
_TEMPLATES = ",\n".join(f"  ({n}, '{words}', '{label}', {str(n < len(op9_licenses.PHRASES)).lower()})" for n, (words, label)
                        in enumerate([*op9_licenses.PHRASES, *op9_licenses.TEMPLATES]))


def _one_of(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


ORACLE["op9_license_scan"] = rf"""
WITH RECURSIVE templates(t, words, label, base) AS (VALUES {_TEMPLATES}),
tw AS (
  SELECT t, label, base, w, len(w) AS m, CASE WHEN len(w) >= 12 THEN 4 ELSE 2 END AS k,
         3 + CAST(floor(len(w) * 0.2 + 1e-9) AS INTEGER) AS slack
  FROM (SELECT *, string_split(words, ' ') AS w FROM templates)),
tg AS (SELECT t, k, i - 1 AS t_at, array_to_string(w[i:i + k - 1], ' ') AS g
       FROM (SELECT *, unnest(range(1, m - k + 2)) AS i FROM tw)),
d AS (SELECT row_number() OVER () AS rn, doc_id, {_LOWER_WORDS} AS w FROM documents),
dg AS (SELECT rn, k, i - 1 AS pos, array_to_string(w[i:i + k - 1], ' ') AS g
       FROM (SELECT rn, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (VALUES (2), (4)) ks(k))),
v AS (SELECT rn, t, pos - t_at AS diag, pos, t_at, k FROM dg JOIN tg USING (k, g)),
base AS (
  SELECT rn, tw.label, min(pos) AS start FROM v JOIN tw USING (t) WHERE base
  GROUP BY rn, t, tw.label, diag, m HAVING count(DISTINCT t_at) = m - 1),
steps AS (
  SELECT *, CASE WHEN prev IS NULL OR diag - prev > 2 THEN 1 ELSE 0 END AS fresh
  FROM (SELECT rn, t, diag, lag(diag) OVER (PARTITION BY rn, t ORDER BY diag) AS prev
        FROM (SELECT DISTINCT rn, t, diag FROM v JOIN tw USING (t) WHERE NOT base))),
grouped AS (SELECT rn, t, diag, sum(fresh) OVER (PARTITION BY rn, t ORDER BY diag) AS grp FROM steps),
known AS (
  SELECT rn, t, grp, count(DISTINCT t_at + o) AS n
  FROM v JOIN grouped USING (rn, t, diag), range(0, 4) offs(o) WHERE o < k GROUP BY rn, t, grp),
near AS (
  SELECT rn, t, diag, greatest(diag - slack, 0) AS fro, m, tw.w AS tw,
         d.w[greatest(diag - slack, 0) + 1:greatest(diag - slack, 0) + m + 2 * slack] AS w
  FROM grouped JOIN known USING (rn, t, grp) JOIN tw USING (t) JOIN d USING (rn) WHERE n / m >= 0.8),
plain AS (
  SELECT *, list_transform(w, lambda x: NOT (x IN {_one_of(op9_licenses.CHANGING)} OR regexp_matches(x, '[0-9]'))) AS ok
  FROM near),
cells(rn, t, diag, fro, m, tw, w, ok, j, c) AS (
  SELECT *, 0, list_transform(range(0, 4 * (len(w) + 1)), lambda i: CASE WHEN i % 4 = 0 THEN 0 ELSE -1000000 END) FROM plain
  UNION ALL
  SELECT rn, t, diag, fro, m, tw, w, ok, j + 1, list_transform(range(0, len(c)), lambda i: greatest(c[i + 1],
           CASE WHEN i % 4 >= 1 AND i >= 5 AND ok[i // 4] THEN c[i - 4] ELSE -1000000 END,
           CASE WHEN i % 4 >= 2 AND i >= 10 AND ok[i // 4] AND ok[i // 4 - 1] THEN c[i - 9] ELSE -1000000 END,
           CASE WHEN i % 4 >= 3 AND i >= 15 AND ok[i // 4] AND ok[i // 4 - 1] AND ok[i // 4 - 2] THEN c[i - 14]
                ELSE -1000000 END))
  FROM (SELECT rn, t, diag, fro, m, tw, w, ok, j, list_transform(range(0, len(c)), lambda i: greatest(
          CASE WHEN tw[j + 1] IN {_one_of(op9_licenses.NAMING)} OR regexp_matches(tw[j + 1], '[0-9]') THEN -1000000
               ELSE c[i + 1] END,
          CASE WHEN i >= 4 AND w[i // 4] = tw[j + 1] THEN c[i - 3] + 1 ELSE -1000000 END)) AS c
        FROM cells WHERE j < m)),
best AS (
  SELECT rn, t, fro, m, list_max(list_transform(range(0, len(c)), lambda i:
           {{'matched': c[i + 1], 'extra': -(i % 4), 'fin': -(i // 4)}})) AS b FROM cells WHERE j = m),
found AS (
  SELECT DISTINCT rn, t, b.matched / m AS coverage, -b.extra AS extra, fro - b.fin - b.matched + b.extra AS start,
         fro - b.fin AS fin FROM best WHERE b.matched / m >= 0.8),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY rn ORDER BY coverage DESC, extra, start - fin, t, start, fin) AS r FROM found),
pick(rn, r, kept, good) AS (
  SELECT rn, CAST(0 AS BIGINT), CAST([] AS STRUCT(s BIGINT, e BIGINT)[]), false FROM (SELECT DISTINCT rn FROM ranked)
  UNION ALL
  SELECT x.rn, x.r, CASE WHEN len(list_filter(kept, lambda o: o.s < x.fin AND x.start < o.e)) > 0 THEN kept
                         ELSE list_append(kept, {{'s': CAST(x.start AS BIGINT), 'e': CAST(x.fin AS BIGINT)}}) END,
         len(list_filter(kept, lambda o: o.s < x.fin AND x.start < o.e)) = 0
  FROM pick JOIN ranked x ON x.rn = pick.rn AND x.r = pick.r + 1),
ok AS (
  SELECT rn, label, true AS base, start, 1.0 AS coverage FROM base
  UNION ALL
  SELECT rn, label, false, start, coverage FROM ranked JOIN pick USING (rn, r) JOIN tw USING (t) WHERE good),
r AS (
  SELECT rn, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
         max(start) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS score FROM ok GROUP BY rn)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN r USING (rn)
"""

ORACLE["op6_warc_revisits"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS x FROM p),
b AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 8), lambda i:
             to_base(CAST('0x' || x[5 * i + 1:5 * i + 5] AS BIGINT), 32, 4)), '') AS d FROM h),
n AS (SELECT page_id, payload_bytes,
             translate(d, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest
      FROM b),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM n GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM n JOIN f USING (payload_digest)
"""

ORACLE["op10_lm_scoring"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, i, w[i] AS b, CASE WHEN i > 1 THEN w[i - 1] END AS a
      FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
c1 AS (SELECT b AS g, count(*) AS n FROM x GROUP BY b),
c2 AS (SELECT a, b, count(*) AS n FROM x WHERE a IS NOT NULL GROUP BY a, b HAVING count(*) >= 2),
t AS (SELECT count(*) AS n FROM x),
s AS (
  SELECT doc_id, c2.n IS NOT NULL AS seen,
         CASE WHEN c2.n IS NOT NULL THEN log10(c2.n) - log10(p.n)
              ELSE log10(u.n) - log10((SELECT n FROM t)) + CASE WHEN x.a IS NULL THEN 0 ELSE log10(0.4) END END AS v
  FROM x JOIN c1 u ON u.g = x.b LEFT JOIN c1 p ON p.g = x.a LEFT JOIN c2 ON c2.a = x.a AND c2.b = x.b)
SELECT d.doc_id, CAST(len(any_value(w)) AS BIGINT) AS n_words, CAST(count(*) FILTER (seen) AS BIGINT) AS n_seen,
       round(coalesce(sum(v), 0), 4) AS score, round(sum(v) / len(any_value(w)), 4) AS mean_score
FROM d LEFT JOIN s ON d.doc_id = s.doc_id GROUP BY d.doc_id
"""

_HOST = (r"translate(coalesce(regexp_extract({u}, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), "
         r"'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
_PATH = r"coalesce(regexp_extract({u}, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '')"
_QUERY = (r"regexp_replace(regexp_replace(regexp_extract({u}, '(?s)^.*?://[^?#]*\?([^#]*)', 1), "
          r"'(^|&)(utm_[a-z]+|gclid|fbclid)(=[^&]*)?', '', 'gi'), '^&', '')")
_KEY = (r"CASE WHEN contains({u}, '://') THEN regexp_replace(" + _HOST + r", ':(80|443)$', '') || regexp_replace("
        + _PATH + r", '/+$', '') || '/' || CASE WHEN " + _QUERY + r" <> '' THEN '?' || " + _QUERY + r" ELSE '' END END")


def _value(name: str) -> str:
    pattern = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))"""
    return "trim(" + " || ".join(f"regexp_extract(tag, '{pattern}', {n})" for n in (1, 2, 3)) + ")"


ORACLE["op13_url_filter_verdicts"] = rf"""
WITH RECURSIVE rules(v, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
u AS (SELECT url, {_HOST.format(u='url')} AS host, {_PATH.format(u='url')} AS path, {_KEY.format(u='url')} AS k
      FROM (SELECT DISTINCT url FROM pages)),
fit AS (
  SELECT url, first(h || p ORDER BY length(h || p) DESC, length(h) DESC, v) AS rule,
         first(v ORDER BY length(h || p) DESC, length(h) DESC, v) AS v
  FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY url),
tags AS (
  SELECT url, unnest(regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>', '', 'g'),
                                        '(?is)<(?:link|meta)\b[^>]*>')) AS tag
  FROM pages WHERE contains(url, '://') AND regexp_matches(html, '(?i)canonical|refresh')),
links AS (
  SELECT url, trim(replace(CASE
    WHEN regexp_matches(lower({_value('rel')}), '(^|\s)canonical(\s|$)') THEN {_value('href')}
    WHEN lower({_value('http-equiv')}) = 'refresh'
    THEN regexp_extract({_value('content')}, '(?is)^[0-9.\s]*[;,]\s*(?:url\s*=\s*)?[''"]?([^''"]*)', 1) END,
    '&amp;', '&')) AS link,
    regexp_extract(url, '(?s)^.*?://[^/?#]*', 0) AS base, regexp_extract(url, '(?s)^.*?://[^?#]*', 0) AS page
  FROM tags),
targets AS (
  SELECT url, CASE
    WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link
    WHEN starts_with(link, '//') THEN regexp_extract(url, '(?s)^(.*?:)//', 1) || link
    WHEN starts_with(link, '/') THEN base || link
    WHEN link = '' OR regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    WHEN starts_with(link, '?') OR starts_with(link, '#') THEN page || link
    WHEN page = base THEN base || '/' || link
    ELSE regexp_extract(page, '(?s)^.*/', 0) || link END AS dst FROM links),
e AS (
  SELECT DISTINCT {_KEY.format(u='url')} AS a, {_KEY.format(u='dst')} AS b FROM targets WHERE dst IS NOT NULL),
both_ways AS (SELECT a, b FROM e WHERE a <> b UNION SELECT b, a FROM e WHERE a <> b),
reach(a, b) AS (SELECT a, a FROM both_ways UNION SELECT reach.a, w.b FROM reach JOIN both_ways w ON w.a = reach.b),
root AS (SELECT a, min(b) AS r FROM reach GROUP BY a),
judged AS (
  SELECT page_id, u.host, u.path, rule, v, coalesce(r, k) AS r
  FROM pages JOIN u ON pages.url IS NOT DISTINCT FROM u.url LEFT JOIN fit ON pages.url = fit.url LEFT JOIN root ON k = root.a),
blocked AS (SELECT r, min(page_id) AS via FROM judged WHERE v = 'block' AND r IS NOT NULL GROUP BY r)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN blocked.r IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
       CASE WHEN v IS NULL THEN via END AS via
FROM judged LEFT JOIN blocked ON judged.r = blocked.r
"""

ORACLE["op11_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rn, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
x AS (SELECT rn, lang, source, unnest(w) AS t FROM d),
kept AS (SELECT lang, t FROM x GROUP BY lang, t HAVING count(DISTINCT rn) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, t, count(*) AS n FROM x JOIN kept USING (lang, t) GROUP BY lang, source, t),
g AS (
  SELECT lang, source, coalesce(any_value(total), 0) AS total, coalesce(any_value(v), 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN v USING (lang)
  LEFT JOIN (SELECT lang, source, CAST(sum(n) AS BIGINT) AS total FROM c GROUP BY lang, source) USING (lang, source)
  GROUP BY lang, source),
p AS (
  SELECT lang, source, t, coalesce(n, 0) AS n,
         CAST(1 + (1000000000 * (coalesce(n, 0) + 2)) // (total + 2 * v) AS BIGINT) AS p
  FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, t)),
lp AS (
  SELECT lang, t, CAST(1 + (1000000000 * (CAST(sum(n) AS BIGINT) + 2)) // (any_value(total) + 2 * any_value(v)) AS BIGINT) AS p
  FROM p JOIN (SELECT lang, CAST(sum(total) AS BIGINT) AS total, any_value(v) AS v FROM g GROUP BY lang) USING (lang)
  GROUP BY lang, t),
pair AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(any_value(s), 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS s
    FROM p a JOIN p b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY a.lang, a.source, b.source) f
    ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  GROUP BY a.lang, a.source, b.source),
term AS (
  SELECT p.lang, p.source, p.t AS item, CAST((p.p - lp.p) * (p.p - lp.p) // (p.p + lp.p) AS BIGINT) AS value
  FROM p JOIN lp ON lp.lang = p.lang AND lp.t = p.t WHERE p.n > 0 AND p.p > lp.p),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
         CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pair
  UNION ALL
  SELECT lang, source, 'term', item, value,
         CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) FROM term)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""
