"""DuckDB SQL of the queries that SQL can express."""

from pageflow.llm import quality_rules as Q

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op8_url_filter"] = r"""
WITH rules(r_host, r_path, r_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
urls AS (
  SELECT row_number() OVER () AS rn, page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
fits AS (
  SELECT rn, r_host || r_path AS rule, r_verdict,
         row_number() OVER (PARTITION BY rn ORDER BY length(r_host) DESC, length(r_path) DESC) AS k
  FROM urls JOIN rules
    ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict
FROM urls LEFT JOIN (SELECT * FROM fits WHERE k = 1) USING (rn)
"""

ORACLE_SQL["op2_jaccard"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
                      ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: w[i:i+4])) END AS s
  FROM words),
tokens AS (SELECT doc_id, unnest(s) AS t FROM sets),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sets a ON a.doc_id = x JOIN sets b ON b.doc_id = y
  WHERE 100 * n >= 75 * (len(a.s) + len(b.s) - n)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets
  UNION
  SELECT reach.doc_id, y FROM reach JOIN edges ON other = x)
SELECT doc_id, len(any_value(s))::BIGINT AS n_shingles, min(other) AS component_id
FROM sets JOIN reach USING (doc_id) GROUP BY doc_id
"""

#: The rule of the shards: a group of equal texts goes where its middle byte lies, a large group row by row.
ORACLE_SQL["op10_shards"] = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS tab),
docs AS (
  SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS t, md5(coalesce(text, '')) AS h,
         strlen(coalesce(text, ''))::BIGINT + 1 AS size
  FROM documents),
summed AS (
  SELECT rn, doc_id, t, h, size, sum(size) OVER () AS total, sum(size) OVER (PARTITION BY h) AS gb,
         sum(size) OVER (ORDER BY h RANGE UNBOUNDED PRECEDING) AS g_end,
         sum(size) OVER (ORDER BY h, doc_id NULLS FIRST, rn ROWS UNBOUNDED PRECEDING) AS r_end
  FROM docs),
placed AS (
  SELECT rn, doc_id, t, h, size,
         least(15, CASE WHEN gb <= 0.01::DOUBLE * total / 16 THEN (2 * (g_end - gb) + gb) * 16 // (2 * total)
                        ELSE (2 * (r_end - size) + size) * 16 // (2 * total) END)::INTEGER AS shard
  FROM summed)
SELECT doc_id, size,
       xor(list_reduce(list_transform(regexp_extract_all(hex(encode(t)), '..'),
             lambda p: 16 * (instr('0123456789ABCDEF', p[1]) - 1) + instr('0123456789ABCDEF', p[2]) - 1),
           lambda acc, b: xor(acc >> 8, tab[xor(acc, b) % 256 + 1]), 4294967295), 4294967295)::BIGINT AS text_crc32,
       'bytes' AS law, shard,
       (row_number() OVER (PARTITION BY shard ORDER BY h, doc_id NULLS FIRST, rn) - 1)::BIGINT AS slot,
       NULL::INTEGER AS grown_shard
FROM placed, crc
"""


def _quality_sql() -> str:
    """Counts, references and Jensen-Shannon distances; a bin without a document's share adds the reference's whole share."""
    common = list(dict.fromkeys(" ".join(Q.LANGUAGES.values()).split()))
    classes = {"lower": "[^a-z]", "upper": "[^A-Z]", "digit": "[^0-9]", "stop": r"[^.,;:!?''\"()-]", "symbol": "[^#*$%&|<>]",
               "space": r"[^\x20\x09-\x0D]", "wide": r"[\x00-\x7F]"}
    counts = ", ".join(f"length(regexp_replace(t, '{drop}', '', 'g')) AS {name}" for name, drop in classes.items())
    other = " - ".join(["length(t)", *classes])
    bins = "\n  UNION ALL ".join(f"SELECT rn, 'char' AS kind, '{name}' AS bin, {name}::BIGINT AS n FROM chars" for name in [*classes, "other"])
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rn, doc_id, lang, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
windows AS (SELECT rn, i, count(*) OVER (PARTITION BY rn, w[i:i+4]) AS found
            FROM (SELECT rn, w, unnest(range(1, len(w) - 3)) AS i FROM docs)),
repeats AS (SELECT rn, count(DISTINCT j) AS n FROM (SELECT rn, unnest(range(i, i + 5)) AS j FROM windows WHERE found > 1) GROUP BY rn),
base AS (
  SELECT docs.rn, doc_id, lang, t, w, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         coalesce(n, 0) AS n_repeat_words
  FROM docs LEFT JOIN repeats USING (rn)),
judged AS (
  SELECT *, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         n_words < {Q.MIN_BASE_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM base),
chars AS (SELECT *, ({other}) AS other FROM (SELECT rn, t, {counts} FROM judged)),
bins AS (
  {bins}
  UNION ALL
  SELECT rn, 'word', CASE WHEN x IN {tuple(common)} THEN x ELSE '' END, count(*) FROM (
    SELECT rn, trim(translate(unnest(w), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '.,;:!?''"()-') AS x FROM judged)
  GROUP BY ALL),
shares AS (SELECT rn, kind, bin, n / sum(n) OVER (PARTITION BY rn, kind) AS p FROM bins WHERE n > 0),
refs AS (
  SELECT lang, kind, bin, sum(n) / sum(sum(n)) OVER (PARTITION BY lang, kind) AS q
  FROM bins JOIN judged USING (rn) WHERE NOT base_failed AND lang IN {tuple(Q.LANGUAGES)} GROUP BY lang, kind, bin),
langs AS (SELECT DISTINCT lang, kind FROM refs),
far AS (
  SELECT rn, kind, sqrt(greatest(0, (sum(p * log2(2 * p / (p + coalesce(q, 0))))
             + sum(CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) + 1 - sum(coalesce(q, 0))) / 2)) AS d
  FROM shares JOIN langs USING (kind) LEFT JOIN refs USING (lang, kind, bin) GROUP BY rn, kind, lang),
nearest AS (SELECT rn, min(d) FILTER (WHERE kind = 'char') AS c, min(d) FILTER (WHERE kind = 'word') AS v FROM far GROUP BY rn)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (word_chars >= {Q.MIN_CHARS} AND coalesce(c, 0) > {Q.MAX_CHAR_DISTANCE})
       AND NOT (n_words >= {Q.MIN_WORDS} AND coalesce(v, 0) > {Q.MAX_WORD_DISTANCE}) AS kept
FROM judged LEFT JOIN nearest USING (rn)
"""


ORACLE_SQL["op7_quality_rules"] = _quality_sql()

ORACLE_SQL["op11_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rn, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
tokens AS (SELECT rn, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term FROM tokens GROUP BY lang, term HAVING count(DISTINCT rn) >= 10),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS c FROM tokens JOIN kept USING (lang, term) GROUP BY ALL),
full_counts AS (
  SELECT lang, source, term, v, coalesce(c, 0) AS c,
         sum(coalesce(c, 0)) OVER (PARTITION BY lang, source) AS n
  FROM groups JOIN kept USING (lang) JOIN sizes USING (lang) LEFT JOIN counts USING (lang, source, term)),
shares AS (SELECT lang, source, term, c, (1 + 1000000000::HUGEINT * (c + 2) // (n + 2 * v))::BIGINT AS p FROM full_counts),
langs AS (
  SELECT lang, term, (1 + 1000000000::HUGEINT * (sum(c) + 2) // (sum(sum(c)) OVER (PARTITION BY lang) + 2 * any_value(v)))::BIGINT AS q
  FROM full_counts GROUP BY lang, term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source != b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT
  FROM shares JOIN langs USING (lang, term) WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, k::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS k FROM found)
WHERE part = 'pair' OR k <= 10
"""

ORACLE_SQL["op13_prefix_trie"] = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS tab),
own AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, xor(list_reduce(list_transform(regexp_extract_all(c::VARCHAR, '.'), lambda x: ord(x)),
                            lambda acc, b: xor(acc >> 8, tab[xor(acc, b) % 256 + 1]), 4294967295), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT c FROM own), crc),
turns AS (
  SELECT convs.c, pos, r, t FROM convs JOIN own ON own.c = convs.c - convs.c % 100 AND pos <= h
  UNION ALL
  SELECT c, pos, r, t FROM convs JOIN own USING (c) WHERE pos > h),
paths AS (
  SELECT convs.c, coalesce(list({'r': r, 't': t} ORDER BY pos) FILTER (pos IS NOT NULL), []) AS s
  FROM convs LEFT JOIN turns USING (c) GROUP BY convs.c),
members AS (SELECT c, d, s[1:d] AS pre, d = len(s) AS ends FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM paths)),
nodes AS (
  SELECT pre, d, min(c) AS conv_id, count(*) AS n, CASE WHEN d = 0 THEN 0 ELSE length(pre[d].t) END AS chars,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY pre, d),
children AS (SELECT pre[1:d-1] AS pre, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
below AS (
  SELECT pre[1:k] AS pre, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n - 1) * chars) AS saved_tokens
  FROM (SELECT nodes.*, n_children, unnest(range(0, d + 1)) AS k FROM nodes LEFT JOIN children USING (pre)) GROUP BY ALL)
SELECT nodes.conv_id, nodes.d AS depth, above.conv_id AS parent_conv_id, nodes.n AS n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, nodes.ends_sha256
FROM nodes JOIN below USING (pre) LEFT JOIN children USING (pre)
LEFT JOIN nodes above ON nodes.d > 0 AND above.pre = nodes.pre[1:nodes.d-1]
"""

ORACLE_SQL["op12_cross_polytope"] = r"""
WITH RECURSIVE rows AS (SELECT row_number() OVER () AS rn, vec_id, embedding::DOUBLE[] AS v FROM embeddings),
good AS (
  SELECT rn, vec_id, v, sqrt(list_inner_product(v, v)) AS size FROM rows
  WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x != 0)) > 0),
links AS (
  SELECT a.rn AS x, b.rn AS y FROM good a JOIN good b ON a.rn != b.rn AND len(a.v) = len(b.v)
  WHERE CASE WHEN len(a.v) = len(b.v) THEN list_inner_product(a.v, b.v) / (a.size * b.size) ELSE 0 END >= 0.9),
reach(rn, other) AS (
  SELECT rn, rn FROM rows
  UNION
  SELECT reach.rn, y FROM reach JOIN links ON other = x),
least AS (SELECT reach.rn, min(vec_id) AS component_id FROM reach JOIN rows ON rows.rn = other GROUP BY reach.rn),
degree AS (SELECT x AS rn, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM rows JOIN least USING (rn) LEFT JOIN degree USING (rn)
"""
