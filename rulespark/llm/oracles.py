"""The queries that SQL can express, in DuckDB's SQL over the same tables."""

from .quality import UNSPACED

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = r"[\x20\x09-\x0D]"

URL_FILTERS = rf"""
WITH rules(rule_host, rule_path, action) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), rests AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages
), urls AS (
  SELECT page_id, {_LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests
), distinct_urls AS (
  SELECT DISTINCT host, path FROM urls
), fitting AS (
  SELECT host, path, rule_host || rule_path AS rule, action,
    row_number() OVER (PARTITION BY host, path
      ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place
  FROM distinct_urls
  JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, u.host, u.path, rule, coalesce(action, 'allow') AS verdict
FROM urls u LEFT JOIN fitting f ON u.host = f.host AND u.path = f.path AND place = 1"""


def mixing(documents):
    return rf"""
WITH rows AS (
  SELECT doc_id, source, len([x for x in regexp_split_to_array(coalesce(text, ''), '{_SPACE}+') if x <> '']) AS size,
    md5(concat_ws(':', 'mix-1', CAST(doc_id AS VARCHAR), text)) AS key
  FROM {documents}
), sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight
  FROM rows GROUP BY source
), levels AS (
  SELECT *, 3 * source_size AS most,
    row_number() OVER (ORDER BY (3 * source_size) / weight, source ASC NULLS LAST) AS place,
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY (3 * source_size) / weight, source ASC NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY (3 * source_size) / weight, source ASC NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sizes
), targets AS (
  SELECT source, source_size, CASE WHEN level * weight >= most THEN CAST(most AS DOUBLE)
    ELSE weight * (SELECT arg_min(level, place) FROM levels WHERE level * weight < most) END AS target
  FROM levels
), placed AS (
  SELECT r.*, source_size, target, CAST(round(target) AS BIGINT) AS budget,
    CAST(coalesce(sum(size) OVER (PARTITION BY r.source ORDER BY key, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
), repeated AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS repeats FROM placed
)
SELECT doc_id, source, size, source_size, target,
  CAST(repeats * size + greatest(0, least(size, budget - repeats * source_size - start)) AS BIGINT) AS taken
FROM repeated"""


DECONTAMINATION = r"""
WITH item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item, [x for x in regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> ''] AS words
  FROM benchmark WHERE text IS NOT NULL
), windows AS (
  SELECT DISTINCT item, array_to_string(list_slice(words, pos, least(pos + 9, len(words))), ' ') AS pattern, least(10, len(words)) AS size
  FROM (SELECT item, words, unnest(range(1, greatest(2, len(words) - 8))) AS pos FROM item_words WHERE len(words) > 0)
), doc_words AS (
  SELECT row_number() OVER () AS rid, doc_id, [x for x in regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> ''] AS words
  FROM documents
), places AS (
  SELECT rid, words, unnest(range(1, len(words) + 1)) AS pos FROM doc_words
), found AS (
  SELECT rid, pos, item, w.size FROM (SELECT DISTINCT size FROM windows) s
  JOIN places ON pos + s.size - 1 <= len(words)
  JOIN windows w ON w.size = s.size AND w.pattern = array_to_string(list_slice(words, pos, pos + s.size - 1), ' ')
), hit AS (
  SELECT rid, count(DISTINCT word) AS n_hit FROM (SELECT rid, unnest(range(pos, pos + size)) AS word FROM found) GROUP BY rid
), listed AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (rid) LEFT JOIN listed USING (rid)"""

QUALITY = rf"""
WITH split AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body,
    [x for x in regexp_split_to_array(coalesce(text, ''), '{_SPACE}+') if x <> ''] AS words,
    [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM documents
), windows AS (
  SELECT rid, pos, array_to_string(list_slice(words, pos, pos + 4), ' ') AS gram
  FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS pos FROM split WHERE len(words) >= 5)
), twice AS (
  SELECT rid, unnest(list(pos)) AS pos FROM windows GROUP BY rid, gram HAVING count(*) > 1
), covered AS (
  SELECT rid, count(DISTINCT word) AS n FROM (SELECT rid, unnest(range(pos, pos + 5)) AS word FROM twice) GROUP BY rid
), measured AS (
  SELECT doc_id, len(words) AS n_words, length(regexp_replace(body, '{_SPACE}+', '', 'g')) AS word_chars,
    length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    length(body) - length(regexp_replace(body, '{UNSPACED}', '', 'g')) AS n_unspaced
  FROM split LEFT JOIN covered USING (rid)
), judged AS (
  SELECT *, CAST((CASE WHEN n_words < 10 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END) + (CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars > 25 * n_words AND 2 * n_unspaced < word_chars THEN 16 ELSE 0 END) + (CASE WHEN word_chars < 2 * n_words THEN 32 ELSE 0 END)
    AS BIGINT) AS failed
  FROM measured
)
SELECT * EXCLUDE (n_unspaced), failed & 3 <> 0 AS base_failed, failed = 0 AS kept FROM judged"""

#: A line's key: stripped, A to Z in lower case.
_KEY = _LOWER.format("trim({line}, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13)))")

LINE_DEDUP = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), split AS (
  SELECT rid, line, pos, {_KEY.format(line="line")} AS key
  FROM (SELECT rid, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM docs)
), frequent AS (
  SELECT key FROM split WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rid) >= 10
), kept AS (
  SELECT rid, count(*) AS n, string_agg(line, chr(10) ORDER BY pos) AS body
  FROM split WHERE key NOT IN (SELECT key FROM frequent) GROUP BY rid
)
SELECT doc_id, len(lines) AS n_lines, len(lines) - coalesce(n, 0) AS n_dropped, sha256(coalesce(body, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (rid)"""

_TERMS = f"regexp_extract_all({_LOWER.format('text')}, '{{}}')".format(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

RANKED_SEARCH = f"""
WITH asked AS (
  SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark
), bodies AS (
  SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL
), corpus AS (
  SELECT CAST(count(*) FILTER (len(terms) > 0) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM bodies
), norms AS (
  SELECT rid, doc_id, CAST(50 + (50 * len(terms) * n_docs) // n_terms AS BIGINT) AS m FROM bodies, corpus WHERE len(terms) > 0
), counts AS (
  SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(terms) AS term FROM bodies)
  WHERE term IN (SELECT term FROM asked) GROUP BY rid, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), corpus
), scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN norms USING (rid) GROUP BY item_id, doc_id, rid
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 50"""

ORACLES = {
    "op2_line_dedup": LINE_DEDUP,
    "op1_url_filters": URL_FILTERS, "op5_decontamination": DECONTAMINATION, "op7_mixing": mixing("documents"),
    "op8_quality_rules": QUALITY, "op11_ranked_search": RANKED_SEARCH,
}
