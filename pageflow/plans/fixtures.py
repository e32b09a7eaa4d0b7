"""Page-view inputs derived by Spark from the driver tables (FIXTURES §4).

The reference reads hourly dump files; the driver ships TPC-H-like tables
instead. These views turn ``events`` x ``part`` into dump lines (one per
event, hour = the event's hour), a keyword dimension from ``part`` names, and
the page-view fact produced by the real lenient parser. Every derived row
comes from a driver row, so the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow.functions import parse as P

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Fixed values of the fixture derivation (FIXTURES §4).
PROJECT_BY_MOD6 = ["en", "en.m", "de", "en", "fr.m", "en.b"]
UNKNOWN_TITLE_EVERY = 41
ESCAPED_SPACE_EVERY = 3
SHORT_LINE_EVERY = 53
# Endings of some titles: escapes and a plus; bare percent signs, quotes and an escape that is none.
ESCAPES_EVERY, ESCAPES = 29, "%20x+y%C3%A9"
MALFORMED_EVERY, MALFORMED = 31, '100%_"q"%zz%20y'
KEYWORD_NOUNS_LIKE = ["%widget%", "%gear%", "%rod%"]
DIRTY_NA_EVERY = 97
DIRTY_NEG_EVERY = 89


_SCHEMAS: dict[str, object] = {}
_PART_KEYS: dict[str, int] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its schema is read from the footer once per path, then
    given explicitly, so later reads plan without a schema-inference job."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def part_keys(spark: SparkSession, sf_dir: str) -> int:
    """One more than the largest part key, so that ``event_id`` modulo it reaches every part (read once per path)."""
    if sf_dir not in _PART_KEYS:
        _PART_KEYS[sf_dir] = table(spark, sf_dir, "part").agg(F.max("p_partkey") + 1).first()[0]
    return _PART_KEYS[sf_dir]


def hour_file_name(ts: Column) -> Column:
    """Dump file name of the hour holding ``ts``: pageviews-YYYYMMDD-HH0000.gz."""
    return F.concat(F.lit("pageviews-"), F.date_format(ts, "yyyyMMdd-HH"), F.lit("0000.gz"))


def hour_file_pattern(ts: Column) -> Column:
    """Relative location of an hourly dump: YYYY/YYYY-MM/pageviews-YYYYMMDD-HH0000.gz."""
    return F.concat(F.date_format(ts, "yyyy/yyyy-MM/"), hour_file_name(ts))


def lines(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """Dump lines ``(file_time, file_name, line)``; one per event.

    ``dirty=True`` makes some counts unusable (``n/a`` or negative), as a
    damaged dump would have them; files holding such a kept row get quarantined.

    Events meet the whole of ``part``, so titles grow with the table.
    """
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    j = e.join(p, F.col("p_partkey") == F.col("event_id") % part_keys(spark, sf_dir))
    eid = F.col("event_id")
    proj = F.element_at(F.array(*[F.lit(x) for x in PROJECT_BY_MOD6]),
                        (eid % len(PROJECT_BY_MOD6)).cast("int") + 1)
    title = (F.when(eid % UNKNOWN_TITLE_EVERY == 0, F.lit("-"))
             .otherwise(F.concat(F.replace(F.col("p_name"), F.lit(" "),
                                           F.when(eid % ESCAPED_SPACE_EVERY == 0, F.lit("%5F")).otherwise(F.lit("_"))),
                                 F.when(eid % ESCAPES_EVERY == 0, F.lit(ESCAPES))
                                 .when(eid % MALFORMED_EVERY == 0, F.lit(MALFORMED)).otherwise(F.lit("")))))
    count = (F.col("user_id") + 1).cast("string")
    if dirty:
        count = (F.when(eid % DIRTY_NA_EVERY == 0, F.lit("n/a"))
                 .when(eid % DIRTY_NEG_EVERY == 0, F.concat(F.lit("-"), count))
                 .otherwise(count))
    tail = (F.when(eid % SHORT_LINE_EVERY == 0, F.lit(""))
            .otherwise(F.concat(F.lit(" "), count, F.lit(" 0"))))
    file_time = F.date_trunc("hour", F.col("ts"))
    return j.select(
        file_time.alias("file_time"),
        hour_file_name(file_time).alias("file_name"),
        F.concat(proj, F.lit(" "), title, tail).alias("line"),
    )


def keyword_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword dimension ``(keyword, category)`` from ``part`` names (distinct)."""
    return keyword_candidates(spark, sf_dir).distinct()


def keyword_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword rows before de-duplication; enough for semi joins, which ignore repeats."""
    p = table(spark, sf_dir, "part")
    like_any = None
    for pat in KEYWORD_NOUNS_LIKE:
        c = F.col("p_name").like(pat)
        like_any = c if like_any is None else like_any | c
    return (p.where(like_any)
            .select(F.replace(F.col("p_name"), F.lit(" "), F.lit("_")).alias("keyword"),
                    F.split_part(F.col("p_name"), F.lit(" "), F.lit(2)).alias("category")))


def pageviews(spark: SparkSession, sf_dir: str, projects=P.DEFAULT_PROJECTS) -> DataFrame:
    """Fact rows ``(time, project, subproject, path, hits)`` via the lenient parse + keyword join."""
    from pageflow.operators.ingest_ops import parse_lenient, keep_keywords
    parsed = parse_lenient(lines(spark, sf_dir), line_col="line", time_col=F.col("file_time"))
    kept = keep_keywords(parsed, keyword_candidates(spark, sf_dir), projects=projects)
    return kept.select("time", "project", "subproject", "path", "hits")


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir, dirty=True)


# Fixed load dates of the double-load fixture (two loads of the same hours).
LOAD_DATES = ["2024-02-01", "2024-02-02"]


def double_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact loaded twice (B3), each copy stamped with its own ``ingestion_date``."""
    pv = pageviews(spark, sf_dir)
    loads = [pv.withColumn("ingestion_date", F.lit(d).cast("date")) for d in LOAD_DATES]
    return loads[0].unionByName(loads[1])


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article corpus ``id, title, text, url`` from ``documents`` (title = first line)."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").cast("string").alias("id"),
                    F.split_part(F.col("text"), F.lit("\n"), F.lit(1)).alias("title"),
                    F.col("text"),
                    F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("url"))


def dirty_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-file outcome of loading the dirty lines: ``file_name, file_time, rows_ok, bad_rows, status``."""
    from pageflow.operators.ingest_ops import file_outcomes, flag_lenient
    flagged = flag_lenient(dirty_lines(spark, sf_dir), keyword_seed(spark, sf_dir), line_col="line",
                           time_col=F.col("file_time"), passthrough=("file_name", "file_time"))
    return file_outcomes(flagged, ["file_name", "file_time"])


def ledger_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of two runs over the dirty hours.

    Run ``r1`` tries every hour (processed two hours after it); run ``r2``
    retries the failed hours with an even hour of day a day later and
    succeeds with their good rows.
    """
    o = dirty_outcomes(spark, sf_dir)
    pattern = hour_file_pattern(F.col("file_time"))
    r1 = o.select(pattern.alias("file_pattern"),
                  F.when(F.col("status") == "success", F.col("rows_ok")).otherwise(F.lit(0)).cast("long")
                  .alias("rows_inserted"),
                  (F.col("file_time") + F.expr("INTERVAL 2 HOURS")).cast("timestamp").alias("processed_at"),
                  F.col("status"),
                  F.when(F.col("status") == "failed",
                         F.concat(F.col("bad_rows").cast("string"), F.lit(" rows with unusable counts")))
                  .alias("error_message"),
                  F.lit("r1").alias("run_id"))
    r2 = (o.where((F.col("status") == "failed") & (F.hour("file_time") % 2 == 0))
          .select(pattern.alias("file_pattern"), F.col("rows_ok").cast("long").alias("rows_inserted"),
                  (F.col("file_time") + F.expr("INTERVAL 1 DAY")).cast("timestamp").alias("processed_at"),
                  F.lit("success").alias("status"), F.lit(None).cast("string").alias("error_message"),
                  F.lit("r2").alias("run_id")))
    return r1.unionByName(r2)


def event_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row ``start, end``: the first and last event time."""
    return table(spark, sf_dir, "events").agg(F.min("ts").alias("start"), F.max("ts").alias("end"))


def listing_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directory-listing lines (one per event) naming the event's hourly dump twice."""
    e = table(spark, sf_dir, "events")
    name = hour_file_name(F.date_trunc("hour", F.col("ts")))
    return e.select(F.concat(F.lit('<a href="'), name, F.lit('">'), name, F.lit("</a> "),
                             F.date_format("ts", "dd-MMM-yyyy HH:mm"), F.lit(" "),
                             F.col("user_id").cast("string")).alias("value"))
