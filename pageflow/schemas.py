"""Fixed schemas of the data model."""

from pyspark.sql import types as T

# Fact table: one row per (hour, project, subproject, page) line kept at load.
PAGEVIEWS = T.StructType([
    T.StructField("time", T.TimestampType()),
    T.StructField("project", T.StringType()),
    T.StructField("subproject", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("hits", T.LongType()),
    T.StructField("ingestion_date", T.DateType()),
])

# The stored fact: partitioned by month and source file.
FACT = T.StructType(PAGEVIEWS.fields + [T.StructField("ym", T.IntegerType()), T.StructField("src_file", T.StringType())])

# Natural key of one fact row.
NATURAL_KEY = ["time", "project", "subproject", "path"]

KEYWORDS = T.StructType([
    T.StructField("keyword", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("added_date", T.DateType()),
])

# Explicit 4-column view of a dump file.
DUMP_ROW = T.StructType([
    T.StructField("project", T.StringType()),
    T.StructField("page_title", T.StringType()),
    T.StructField("view_count", T.LongType()),
    T.StructField("bytes_served", T.LongType()),
])

DUMP_ROW_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in DUMP_ROW.fields])

# Append-only ledger; the current state of a file is its latest row.
LEDGER = T.StructType([
    T.StructField("file_pattern", T.StringType()),
    T.StructField("rows_inserted", T.LongType()),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("run_id", T.StringType()),
])

LOAD_STATS = T.StructType([
    T.StructField("date_pattern", T.StringType()),
    T.StructField("rows_inserted", T.LongType()),
    T.StructField("load_timestamp", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
])

TOP_PAGE = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("hits", T.LongType()),
    T.StructField("records", T.LongType()),
])

CATEGORY_ROW = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("unique_pages", T.LongType()),
    T.StructField("hits", T.LongType()),
])

SUMMARY = T.StructType([
    T.StructField("total_rows", T.LongType()),
    T.StructField("top_pages", T.ArrayType(TOP_PAGE)),
    T.StructField("category_breakdown", T.ArrayType(CATEGORY_ROW)),
    T.StructField("generated_at", T.TimestampType()),
])

ARTICLES = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("url", T.StringType()),
])

MANIFEST = T.StructType([T.StructField("file_pattern", T.StringType())])
