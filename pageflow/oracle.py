"""DuckDB SQL that computes the same results as the registered Spark queries.

Used by the driver's correctness gate and by ``tests/test_oracle.py``. The
derived views mirror ``pageflow.plans.fixtures`` (FIXTURES §4); the only
engine-specific piece is URL decoding (``url_decode`` here, the lenient
decode expression in Spark).
"""

from __future__ import annotations

from pageflow.functions.text import MENTION_TERMS, TITLE_PATTERN, TOPIC_TERMS

LINES = """
lines AS (
  SELECT date_trunc('hour', e.ts) AS file_time,
         'pageviews-' || strftime(date_trunc('hour', e.ts), '%Y%m%d-%H') || '0000.gz' AS file_name,
         (CASE e.event_id % 6 WHEN 0 THEN 'en' WHEN 1 THEN 'en.m' WHEN 2 THEN 'de'
                              WHEN 3 THEN 'en' WHEN 4 THEN 'fr.m' ELSE 'en.b' END)
         || ' ' || (CASE WHEN e.event_id % 41 = 0 THEN '-'
                    ELSE replace(p.p_name, ' ', CASE WHEN e.event_id % 3 = 0 THEN '%5F' ELSE '_' END)
                      || CASE WHEN e.event_id % 29 = 0 THEN '%20x+y%C3%A9' WHEN e.event_id % 31 = 0 THEN '100%_"q"%zz%20y'
                              ELSE '' END END)
         || (CASE WHEN e.event_id % 53 = 0 THEN ''
                  ELSE ' ' || CAST(e.user_id + 1 AS VARCHAR) || ' 0' END) AS line
  FROM events e JOIN part p ON p.p_partkey = e.event_id % (SELECT max(p_partkey) + 1 FROM part)
)"""

KEYWORDS = """
keywords AS (
  SELECT DISTINCT replace(p_name, ' ', '_') AS keyword, split_part(p_name, ' ', 2) AS category
  FROM part
  WHERE p_name LIKE '%widget%' OR p_name LIKE '%gear%' OR p_name LIKE '%rod%'
)"""

PARSED = """
parsed AS (
  SELECT file_time AS time, file_name,
         split_part(split_part(line, ' ', 1), '.', 1) AS project,
         split_part(split_part(line, ' ', 1), '.', 2) AS subproject,
         split_part(line, ' ', 2) AS raw_title,
         url_decode(split_part(line, ' ', 2)) AS path,
         TRY_CAST(split_part(line, ' ', 3) AS BIGINT) AS hits
  FROM lines
  WHERE len(string_split(line, ' ')) >= 3 AND split_part(line, ' ', 2) <> '-'
)"""

PAGEVIEWS = """
pageviews AS (
  SELECT time, project, subproject, path, hits
  FROM parsed
  WHERE project IN ('en', 'en.m') AND path IN (SELECT keyword FROM keywords)
)"""

FACT = "WITH " + ",".join([LINES, KEYWORDS, PARSED, PAGEVIEWS]) + "\n"


def _fact(sql: str) -> str:
    return FACT + sql


QUERIES: dict[str, str] = {
    "top_pages": _fact("""
SELECT path, CAST(sum(hits) AS BIGINT) AS total_hits, count(*) AS records
FROM pageviews GROUP BY path ORDER BY total_hits DESC, path LIMIT 10"""),

    "category_breakdown": _fact("""
SELECT kw.category, count(DISTINCT w.path) AS unique_pages, CAST(sum(w.hits) AS BIGINT) AS total_hits
FROM pageviews w JOIN (SELECT DISTINCT keyword, category FROM keywords) kw ON w.path = kw.keyword
GROUP BY kw.category ORDER BY total_hits DESC, kw.category"""),

    "row_count": _fact("SELECT count(*) AS total_rows FROM pageviews"),

    "daily_trend": _fact("""
SELECT CAST(time AS DATE) AS date, CAST(sum(hits) AS BIGINT) AS daily_views
FROM pageviews WHERE path = 'red_widget' GROUP BY 1 ORDER BY 1"""),

    "table_health": _fact("""
SELECT count(*) AS total_rows, min(time) AS earliest_date, max(time) AS latest_date,
       count(DISTINCT path) AS unique_pages FROM pageviews"""),

    "coverage": _fact("""
SELECT count(*) AS rows, count(DISTINCT CAST(time AS DATE)) AS days, min(time) AS earliest, max(time) AS latest
FROM pageviews"""),

    "trailing_week_top": _fact("""
SELECT path, CAST(sum(hits) AS BIGINT) AS total_views
FROM pageviews
WHERE time >= CAST(CAST((SELECT max(time) FROM pageviews) AS DATE) - 7 AS TIMESTAMP)
GROUP BY path ORDER BY total_views DESC, path LIMIT 10"""),
}

DOUBLE_LOAD = """
dl AS (
  SELECT *, DATE '2024-02-01' AS ingestion_date FROM pageviews
  UNION ALL
  SELECT *, DATE '2024-02-02' AS ingestion_date FROM pageviews
)"""

DIRTY = """
dlines AS (
  SELECT date_trunc('hour', e.ts) AS file_time,
         'pageviews-' || strftime(date_trunc('hour', e.ts), '%Y%m%d-%H') || '0000.gz' AS file_name,
         (CASE e.event_id % 6 WHEN 0 THEN 'en' WHEN 1 THEN 'en.m' WHEN 2 THEN 'de'
                              WHEN 3 THEN 'en' WHEN 4 THEN 'fr.m' ELSE 'en.b' END)
         || ' ' || (CASE WHEN e.event_id % 41 = 0 THEN '-'
                    ELSE replace(p.p_name, ' ', CASE WHEN e.event_id % 3 = 0 THEN '%5F' ELSE '_' END)
                      || CASE WHEN e.event_id % 29 = 0 THEN '%20x+y%C3%A9' WHEN e.event_id % 31 = 0 THEN '100%_"q"%zz%20y'
                              ELSE '' END END)
         || (CASE WHEN e.event_id % 53 = 0 THEN ''
                  ELSE ' ' || (CASE WHEN e.event_id % 97 = 0 THEN 'n/a'
                                    WHEN e.event_id % 89 = 0 THEN '-' || CAST(e.user_id + 1 AS VARCHAR)
                                    ELSE CAST(e.user_id + 1 AS VARCHAR) END) || ' 0' END) AS line
  FROM events e JOIN part p ON p.p_partkey = e.event_id % (SELECT max(p_partkey) + 1 FROM part)
),
dflag0 AS (
  SELECT file_name, file_time,
         (len(string_split(line, ' ')) >= 3 AND split_part(line, ' ', 2) <> '-')
         AND split_part(split_part(line, ' ', 1), '.', 1) IN ('en', 'en.m')
         AND url_decode(split_part(line, ' ', 2)) IN (SELECT keyword FROM keywords) AS kept,
         TRY_CAST(split_part(line, ' ', 3) AS BIGINT) AS hits
  FROM dlines
),
dflag AS (SELECT file_name, file_time, kept, kept AND (hits IS NULL OR hits < 0) AS bad FROM dflag0),
outcomes AS (
  SELECT file_name, file_time,
         count(*) FILTER (WHERE kept AND NOT bad) AS rows_ok,
         count(*) FILTER (WHERE bad) AS bad_rows,
         CASE WHEN count(*) FILTER (WHERE bad) > 0 THEN 'failed' ELSE 'success' END AS status
  FROM dflag GROUP BY file_name, file_time
),
ledger AS (
  SELECT strftime(file_time, '%Y/%Y-%m/') || file_name AS file_pattern,
         CAST(CASE WHEN status = 'success' THEN rows_ok ELSE 0 END AS BIGINT) AS rows_inserted,
         file_time + INTERVAL 2 HOUR AS processed_at, status,
         CASE WHEN status = 'failed' THEN CAST(bad_rows AS VARCHAR) || ' rows with unusable counts' END
           AS error_message,
         'r1' AS run_id
  FROM outcomes
  UNION ALL
  SELECT strftime(file_time, '%Y/%Y-%m/') || file_name, CAST(rows_ok AS BIGINT), file_time + INTERVAL 1 DAY,
         'success', NULL, 'r2'
  FROM outcomes WHERE status = 'failed' AND hour(file_time) % 2 = 0
),
ledger_latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY file_pattern ORDER BY processed_at DESC) AS rn FROM ledger)
  WHERE rn = 1
),
manifest AS (
  SELECT strftime(t, '%Y/%Y-%m/') || 'pageviews-' || strftime(t, '%Y%m%d-%H') || '0000.gz' AS file_pattern,
         'pageviews-' || strftime(t, '%Y%m%d-%H') || '0000.gz' AS file_name, t AS file_time
  FROM (SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)),
                                      INTERVAL 1 HOUR)) AS t FROM events)
)"""

ARTICLES = """
WITH articles AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, split_part(text, chr(10), 1) AS title, text,
         source || '/' || CAST(doc_id AS VARCHAR) AS url
  FROM documents
)
"""

def _flag(terms: list[str]) -> str:
    """1 if the lower-cased text holds any of the terms or the lower-cased title is like the title pattern."""
    return (f"(CAST(list_bool_or([contains(lower(text), t) FOR t IN {terms}]) AS BOOLEAN)"
            f" OR lower(title) LIKE '{TITLE_PATTERN}')::INTEGER")


REF_FLAG = _flag(TOPIC_TERMS)
VOCAB_FLAG = _flag(["the"])
MENTIONS = ", ".join(f"(length(text) - length(replace(lower(text), '{t}', ''))) / {len(t)} AS {name}"
                     for name, t in MENTION_TERMS.items())

STRICT_RE = r"^([^ .]+)(\.[^ ]+)? +([^ ]+) +(\d+) +(\d+)$"

TOP_SQL = ("SELECT path, CAST(sum(hits) AS BIGINT) AS total_hits, count(*) AS records FROM pageviews "
           "GROUP BY path ORDER BY total_hits DESC, path LIMIT 10")
CAT_SQL = ("SELECT kw.category, count(DISTINCT w.path) AS unique_pages, CAST(sum(w.hits) AS BIGINT) AS total_hits "
           "FROM pageviews w JOIN (SELECT DISTINCT keyword, category FROM keywords) kw ON w.path = kw.keyword "
           "GROUP BY kw.category")


def _dl(sql: str) -> str:
    return FACT.rstrip() + "," + DOUBLE_LOAD + "\n" + sql


def _dirty(sql: str) -> str:
    return "WITH " + ",".join([LINES, KEYWORDS, PARSED, PAGEVIEWS, DIRTY]) + "\n" + sql


def _top_articles(flag: str) -> str:
    return ARTICLES + f"""SELECT title, url, article_length, de_mentions, etl_mentions, pipeline_mentions,
       spark_mentions, summary FROM (
  SELECT id, title, url, length(text) AS article_length, {MENTIONS},
         split_part(text, chr(10) || chr(10), 1) AS summary
  FROM articles WHERE ({flag}) = 1
  ORDER BY article_length DESC, id LIMIT 100)"""


QUERIES.update({
    "collapse_sum": _dl("""
SELECT time, project, subproject, path, CAST(sum(hits) AS BIGINT) AS hits, max(ingestion_date) AS ingestion_date
FROM dl GROUP BY time, project, subproject, path"""),

    "keep_latest": _dl("""
SELECT time, project, subproject, path, ingestion_date, hits FROM (
  SELECT *, row_number() OVER (PARTITION BY time, project, subproject, path
                               ORDER BY ingestion_date DESC, hits DESC) AS rn FROM dl)
WHERE rn = 1"""),

    "drop_duplicates": _dl("SELECT DISTINCT time, project, subproject, path, hits FROM dl"),

    "dedup_loads": _dl("""
SELECT time, project, subproject, path, ingestion_date, hits FROM (
  SELECT *, row_number() OVER (PARTITION BY time, project, subproject, path
                               ORDER BY ingestion_date DESC, hits DESC) AS rn
  FROM (SELECT time, project, subproject, path, ingestion_date, CAST(sum(hits) AS BIGINT) AS hits
        FROM dl GROUP BY ALL))
WHERE rn = 1"""),

    "table_rebuild": _dl("""
SELECT time, project, subproject, path, CAST(sum(hits) AS BIGINT) AS hits
FROM dl GROUP BY time, project, subproject, path"""),

    "parse_lenient": _fact("SELECT time, project, subproject, raw_title, path, hits FROM parsed"),

    "parse_strict": "WITH " + LINES + f"""
SELECT file_time AS time,
       regexp_extract(line, '{STRICT_RE}', 1) AS project,
       regexp_extract(line, '{STRICT_RE}', 2) AS subproject,
       regexp_extract(line, '{STRICT_RE}', 3) AS path,
       TRY_CAST(regexp_extract(line, '{STRICT_RE}', 4) AS BIGINT) AS hits
FROM lines WHERE regexp_matches(line, '{STRICT_RE}')""",

    "timestamp_from_filename": r"""
WITH names AS (
  SELECT DISTINCT file_name FROM (
    SELECT 'pageviews-' || strftime(date_trunc('hour', ts), '%Y%m%d-%H') || '0000.gz' AS file_name FROM events
    UNION ALL
    SELECT 'pageviews-' || event_type || '.gz' FROM events)
)
SELECT file_name,
       try_strptime(regexp_extract(file_name, 'pageviews-(\d{8}-\d{6})\.gz', 1), '%Y%m%d-%H%M%S') AS time_from_name,
       try_strptime(regexp_replace('/dumps/2024/2024-01/' || file_name,
                                   '^.+pageviews-(\d{4})(\d{2})(\d{2})-(\d{2})(\d{2})(\d{2})\.gz$',
                                   '\1-\2-\3 \4:\5:\6'), '%Y-%m-%d %H:%M:%S') AS time_from_path
FROM names""",

    "file_quarantine": _dirty("SELECT file_name, rows_ok, bad_rows, status FROM outcomes"),

    "keyword_seed": "WITH " + KEYWORDS + "\nSELECT DISTINCT keyword, category FROM keywords",

    "file_manifest": _dirty("SELECT file_pattern, file_name, file_time FROM manifest"),

    "listing_manifest": r"""
WITH listing AS (
  SELECT '<a href="' || n || '">' || n || '</a>' AS value
  FROM (SELECT 'pageviews-' || strftime(date_trunc('hour', ts), '%Y%m%d-%H') || '0000.gz' AS n FROM events)
)
SELECT DISTINCT file_name,
       regexp_replace(file_name, '^pageviews-([0-9]{4})([0-9]{2})[0-9]{2}-[0-9]+\.gz$',
                      'https://dumps.example/pageviews/\1/\1-\2/\0') AS url
FROM (SELECT unnest(regexp_extract_all(value, 'pageviews-[0-9]+-[0-9]+\.gz')) AS file_name FROM listing)""",

    "ledger_latest": _dirty("SELECT file_pattern, processed_at, rows_inserted, status, error_message, run_id FROM ledger_latest"),

    "ledger_status": _dirty("""
SELECT status, count(*) AS files, CAST(sum(rows_inserted) AS BIGINT) AS total_rows
FROM ledger_latest GROUP BY status"""),

    "latest_loads": _dirty("""
SELECT file_pattern, rows_inserted, processed_at, status FROM ledger
ORDER BY processed_at DESC, file_pattern, status LIMIT 10"""),

    "run_summary": _dirty("""
SELECT run_id, count(*) AS attempted, count(*) FILTER (WHERE status = 'success') AS succeeded,
       count(*) FILTER (WHERE status = 'failed') AS failed,
       CAST(sum(CASE WHEN status = 'success' THEN rows_inserted ELSE 0 END) AS BIGINT) AS rows_inserted
FROM ledger GROUP BY run_id"""),

    "pending_files": _dirty("""
SELECT file_pattern FROM manifest
WHERE file_pattern NOT IN (SELECT file_pattern FROM ledger_latest WHERE status = 'success')"""),

    "table_census": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                  "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]),

    "summary_snapshot": _fact(f"""
SELECT (SELECT count(*) FROM pageviews) AS total_rows,
       (SELECT list(struct_pack(path := path, hits := total_hits, records := records)
                    ORDER BY total_hits DESC, path) FROM ({TOP_SQL})) AS top_pages,
       (SELECT list(struct_pack(category := category, unique_pages := unique_pages, hits := total_hits)
                    ORDER BY total_hits DESC, category) FROM ({CAT_SQL})) AS category_breakdown,
       (SELECT max(time) FROM pageviews) AS generated_at"""),

    "topic_flag": ARTICLES + f"SELECT id, length(text) AS article_length, {REF_FLAG} AS is_data_engineering FROM articles",

    "mention_counts": ARTICLES + f"SELECT id, {MENTIONS} FROM articles",

    "first_paragraph": ARTICLES + "SELECT id, split_part(text, chr(10) || chr(10), 1) AS summary FROM articles",

    "top_articles": _top_articles(VOCAB_FLAG),

    "top_articles_reference_terms": _top_articles(REF_FLAG),

    "article_export": ARTICLES + f"""
SELECT id, title, text, url, length(text) AS article_length, {VOCAB_FLAG} AS is_data_engineering
FROM articles WHERE ({VOCAB_FLAG}) = 1""",
})

DUMP_ROWS = """
dump AS (
  SELECT split_part(line, ' ', 1) AS project, split_part(line, ' ', 2) AS page_title,
         TRY_CAST(NULLIF(split_part(line, ' ', 3), '') AS BIGINT) AS view_count,
         TRY_CAST(NULLIF(split_part(line, ' ', 4), '') AS BIGINT) AS bytes_served,
         NULLIF(split_part(line, ' ', 3), '') AS view_count_text,
         NULLIF(split_part(line, ' ', 4), '') AS bytes_served_text
  FROM lines
)"""


def _dump(sql: str) -> str:
    return "WITH " + LINES + "," + DUMP_ROWS + "\n" + sql


QUERIES.update({
    "dump_scan": _dump("SELECT project, page_title, view_count, bytes_served FROM dump WHERE project IS NOT NULL"),
    "title_in_list": _dump("""
SELECT page_title, view_count, bytes_served FROM dump
WHERE page_title IN ('red_widget', 'blue_widget', 'small_gear', 'hot_gear', 'big_rod', 'DuckDB')"""),
    "title_like_mix": _dump("""
SELECT page_title, view_count, bytes_served FROM dump
WHERE page_title LIKE '%red%widget%' OR page_title LIKE '%GEAR%' OR page_title LIKE '%rod%'
   OR page_title IN ('blue_bolt', 'small_ring')"""),
    "raw_preview": _dump("""
SELECT project, page_title, view_count_text AS view_count, bytes_served_text AS bytes_served FROM dump
ORDER BY project NULLS FIRST, page_title NULLS FIRST, view_count_text NULLS FIRST, bytes_served_text NULLS FIRST
LIMIT 20"""),
    "line_scan": "WITH " + LINES + "\nSELECT line, file_name, file_time AS time FROM lines",
    "file_ingest": _fact("SELECT time, project, subproject, path, hits FROM pageviews"),
    "stream_load": _fact("SELECT time, project, subproject, path, hits FROM pageviews"),
})

QUERIES["load_stats"] = _dirty("""
SELECT file_pattern AS date_pattern, rows_inserted, processed_at AS load_timestamp, status, error_message
FROM ledger WHERE run_id = 'r1'""")

QUERIES["history_load"] = "WITH " + LINES + """
SELECT file_time AS time,
       split_part(split_part(line, ' ', 1), '.', 1) AS project,
       split_part(split_part(line, ' ', 1), '.', 2) AS subproject,
       url_decode(split_part(line, ' ', 2)) AS path,
       TRY_CAST(split_part(line, ' ', 3) AS BIGINT) AS hits
FROM lines WHERE len(string_split(line, ' ')) >= 3"""

QUERIES["strict_load"] = "WITH " + LINES + f"""
SELECT file_time AS time,
       regexp_extract(line, '{STRICT_RE}', 1) AS project,
       regexp_extract(line, '{STRICT_RE}', 2) AS subproject,
       regexp_extract(line, '{STRICT_RE}', 3) AS path,
       TRY_CAST(regexp_extract(line, '{STRICT_RE}', 4) AS BIGINT) AS hits
FROM lines WHERE regexp_matches(line, '{STRICT_RE}')"""

QUERIES["append_twice"] = _fact("""
SELECT time, project, subproject, path, hits FROM pageviews
UNION ALL
SELECT time, project, subproject, path, hits FROM pageviews""")

for _name in ("top_pages", "daily_trend", "trailing_week_top"):
    QUERIES[f"fact_{_name}"] = QUERIES[_name]

QUERIES["replay_load"] = _fact("""
SELECT time, project, subproject, path, hits, CAST(strftime(time, '%Y%m') AS INTEGER) AS ym,
       'pageviews-' || strftime(time, '%Y%m%d-%H') || '0000.gz' AS src_file
FROM pageviews""")

# A column is an int if all its values are; a missing field has none.
QUERIES["schema_profile"] = _dump(" UNION ALL ".join(
    f"""SELECT {k} AS ordinal, '_c{k}' AS column_name,
       CASE WHEN count({c}) > 0 AND bool_and({c} IS NULL OR TRY_CAST({c} AS INTEGER) IS NOT NULL) THEN 'int' ELSE 'string' END
         AS data_type FROM dump"""
    for k, c in enumerate(["project", "page_title", "view_count_text", "bytes_served_text"])))

QUERIES["snapshot_load"] = QUERIES["replay_load"]
QUERIES["snapshot_daily_trend"] = QUERIES["daily_trend"]
QUERIES["snapshot_summary"] = QUERIES["summary_replace"] = QUERIES["summary_snapshot"]

QUERIES["merge_latest"] = _fact("""
SELECT time, project, subproject, path, CASE WHEN hour(time) = 23 THEN DATE '2024-02-02' ELSE DATE '2024-02-01' END AS ingestion_date,
       CAST(max(hits) + CASE WHEN hour(time) = 23 THEN 1 ELSE 0 END AS BIGINT) AS hits
FROM pageviews GROUP BY time, project, subproject, path""")

QUERIES["truncate_reload"] = _dirty("""
SELECT file_pattern, 2 AS loads, count(hits) AS rows, CAST(coalesce(sum(hits), 0) AS BIGINT) AS hits
FROM manifest LEFT JOIN pageviews ON time = file_time GROUP BY file_pattern""")

QUERIES["backfill_load"] = _fact("SELECT time, project, subproject, path, hits, 1 AS loads FROM pageviews")

QUERIES["catalog_defaults"] = _fact("""
SELECT 'keywords' AS table_name, keyword AS name, true AS stamped, count(*) AS rows FROM keywords GROUP BY keyword
UNION ALL
SELECT 'pageviews', path, true, count(*) FROM pageviews GROUP BY path""")
