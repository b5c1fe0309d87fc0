"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_SPACE = r"[\x{20}\x{09}-\x{0D}]"

OP5 = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), placed AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), rules(h, p, action) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), judged AS (
  SELECT page_id, host, path, (
    SELECT arg_max({'rule': h || p, 'action': action}, length(h || p)) FROM rules
    WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS best
  FROM placed
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.action, 'allow') AS verdict FROM judged
"""

OP6 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), LOWER), '[\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+'),
         lambda w: w <> '') AS w FROM documents
), items AS (
  SELECT item_id::VARCHAR AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), LOWER), '[\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+'),
         lambda w: w <> '') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(10, len(w)) AS size, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS words
  FROM items, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS s(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT d, i, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS words
  FROM docs, sizes, unnest(generate_series(1, len(w) - size + 1)) AS s(i)
), hits AS (SELECT d, i, p.size, item FROM places p JOIN windows v ON p.size = v.size AND p.words = v.words),
hit_words AS (SELECT d, count(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT d, i, size FROM hits), unnest(generate_series(0, size - 1)) AS s(k) GROUP BY d),
hit_items AS (SELECT d, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hits GROUP BY d)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (d) LEFT JOIN hit_items USING (d)
""".replace("LOWER", _LOWER)

OP7 = r"""
WITH lines AS (
  SELECT d, doc_id, i, list_extract(l, i) AS line,
         translate(regexp_replace(regexp_replace(list_extract(l, i), '^SPACE+', ''), 'SPACE+$', ''), LOWER) AS key
  FROM (SELECT row_number() OVER () AS d, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents) AS x, unnest(generate_series(1, len(l))) AS s(i)
), bad AS (SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT d) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(b.key)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE b.key IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN bad b USING (key) GROUP BY d
""".replace("LOWER", _LOWER).replace("SPACE", _SPACE)

OP8 = r"""
WITH digests AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS hex FROM pages
), firsts AS (SELECT hex, min(page_id) AS first FROM digests GROUP BY hex),
fives AS (
  SELECT page_id, n, hex, list_transform(generate_series(0, 7), lambda i: ('0x' || substr(hex, CAST(i * 5 + 1 AS BIGINT), 5))::BIGINT) AS v FROM digests
)
SELECT page_id, n::BIGINT AS payload_bytes,
       array_to_string(list_transform(v, lambda x:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x >> 15) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> 10) & 31) + 1, 1) ||
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> 5) & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM fives JOIN firsts USING (hex)
"""


def _deal(name: str, nodes: str, parents: str) -> str:
    """One level of the mix: how ``budget`` of a parent is dealt to its children by weight, each at most its room."""
    return f"""
{name}_ordered AS (
  SELECT *, room / weight AS ratio FROM ({nodes})
), {name}_poured AS (
  SELECT *, (budget - coalesce(sum(room) OVER (PARTITION BY {parents} ORDER BY ratio, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (PARTITION BY {parents} ORDER BY ratio, name ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS pour
  FROM {name}_ordered
), {name}_level AS (
  SELECT *, ratio <= pour AS full_up, min(CASE WHEN ratio > pour THEN {{'r': ratio, 'n': name, 'p': pour}} END) OVER (PARTITION BY {parents}) AS lev
  FROM {name}_poured
), {name} AS (SELECT *, CASE WHEN full_up THEN room::DOUBLE ELSE greatest(0.0, lev.p * weight) END AS share FROM {name}_level)"""


OP10 = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}+'), lambda w: w <> ''))::BIGINT AS tokens,
         regexp_extract(coalesce(source, ''), '([0-9]+)$', 1) AS number FROM documents
), placed AS (
  SELECT *, CASE WHEN number = '' THEN 'other' ELSE list_extract(['web', 'reference', 'forum'],
            ((length(number) + right(number, 1)::INT) % 3 + 1)::INT) END AS domain FROM docs
), leaves AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens, 2 * sum(tokens)::BIGINT AS room FROM placed GROUP BY ALL),
domain_weights(name, weight) AS (VALUES ('web', 50), ('reference', 30), ('forum', 20)),
lang_weights(name, weight) AS (VALUES ('en', 55), ('de', 20), ('fr', 15), ('es', 10)),
{_deal("d", '''SELECT 0 AS everything, domain, domain AS name, sum(room) AS room, (SELECT floor(sum(tokens) * 0.6) FROM leaves) AS budget,
                      coalesce(any_value(weight), 1) AS weight FROM leaves LEFT JOIN domain_weights w ON w.name = domain GROUP BY domain''', "everything")},
{_deal("l", '''SELECT x.*, coalesce(w.weight, 1) AS weight FROM (SELECT domain, lang, lang AS name, sum(leaves.room) AS room, max(d.share) AS budget
                      FROM leaves JOIN d USING (domain) GROUP BY domain, lang) x LEFT JOIN lang_weights w ON w.name = x.lang''', "domain")},
{_deal("s", '''SELECT leaves.domain, leaves.lang, leaves.source, leaves.source AS name, leaves.tokens, leaves.room, l.share AS budget, 1 AS weight
                      FROM leaves JOIN l ON l.domain = leaves.domain AND l.lang = leaves.lang''', "domain, lang")},
plan AS (
  SELECT domain, lang, source, CASE WHEN tokens > 0 THEN floor(share / tokens)::BIGINT ELSE 0 END AS whole,
         share - CASE WHEN tokens > 0 THEN floor(share / tokens)::BIGINT ELSE 0 END * tokens AS rest FROM s
), ordered AS (
  SELECT p.*, whole, rest, md5('42|' || whole::VARCHAR || '|' || coalesce(doc_id::VARCHAR, '')) AS key FROM placed p JOIN plan USING (domain, lang, source)
), cut AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key RANGE UNBOUNDED PRECEDING)
            - sum(tokens) OVER (PARTITION BY domain, lang, source, key) AS earlier FROM ordered
)
SELECT doc_id, domain, lang, source, tokens AS n_tokens, e::BIGINT AS epoch
FROM cut, unnest(generate_series(0, (whole + CASE WHEN earlier < rest THEN 1 ELSE 0 END - 1)::BIGINT)) AS t(e)
"""

OP11 = r"""
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM whole a JOIN whole r ON r.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), negatives AS (
  SELECT anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
  FROM positives JOIN scored s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10
"""

OP12 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), 'SPACE+'), lambda w: w <> '') AS w FROM documents
), windows AS (
  SELECT d, doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS words FROM docs, unnest(generate_series(1, len(w) - 12)) AS s(i)
), firsts AS (SELECT words, min(doc_id) AS first FROM windows GROUP BY words HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT d, i + k AS i FROM windows JOIN firsts USING (words), unnest(generate_series(0, 12)) AS s(k) WHERE doc_id > first),
kept AS (
  SELECT x.d, count(*) AS n, string_agg(word, ' ' ORDER BY x.i) AS kept
  FROM (SELECT d, i, list_extract(w, i) AS word FROM docs, unnest(generate_series(1, len(w))) AS s(i)) x ANTI JOIN gone USING (d, i) GROUP BY x.d
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (d)
""".replace("SPACE", _SPACE)

ORACLES = {"op5_url_filter": OP5, "op6_decontamination": OP6, "op7_line_dedup": OP7, "op8_warc": OP8, "op10_mixing": OP10,
           "op11_hard_negatives": OP11, "op12_substring_dedup": OP12}
