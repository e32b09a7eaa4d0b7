"""File manifests: which hourly dumps exist or should be loaded.

Manifests are built with Spark expressions (``sequence`` + ``explode``,
``regexp_extract_all``), never with driver loops; their size is the number of
hours in the calendar span, not the data volume.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Dump naming and archive layout.
LISTED_NAME_REGEX = r"pageviews-[0-9]+-[0-9]+\.gz"
NAME_TO_LOCATION_REGEX = r"^pageviews-([0-9]{4})([0-9]{2})[0-9]{2}-[0-9]+\.gz$"
NAME_TO_LOCATION_TEMPLATE = "$1/$1-$2/$0"


def file_name_of(ts: Column) -> Column:
    """pageviews-YYYYMMDD-HH0000.gz for the hour of ``ts``."""
    return F.concat(F.lit("pageviews-"), F.date_format(ts, "yyyyMMdd-HH"), F.lit("0000.gz"))


def file_pattern_of(ts: Column) -> Column:
    """YYYY/YYYY-MM/pageviews-YYYYMMDD-HH0000.gz for the hour of ``ts``."""
    return F.concat(F.date_format(ts, "yyyy/yyyy-MM/"), file_name_of(ts))


def _with_patterns(hours: DataFrame) -> DataFrame:
    return hours.select(file_pattern_of(F.col("file_time")).alias("file_pattern"),
                        file_name_of(F.col("file_time")).alias("file_name"),
                        F.col("file_time"))


def hourly_manifest(bounds: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """One row per hour from ``start`` to ``end`` (inclusive) of each bounds row."""
    seq = F.sequence(F.date_trunc("hour", F.col(start_col)), F.date_trunc("hour", F.col(end_col)),
                     F.expr("INTERVAL 1 HOUR"))
    return _with_patterns(bounds.select(F.explode(seq).alias("file_time")))


def hourly_manifest_between(spark: SparkSession, start: _dt.datetime, end: _dt.datetime) -> DataFrame:
    """S7 for literal bounds (a backfill window)."""
    b = spark.range(1).select(F.lit(start).cast("timestamp").alias("start"),
                              F.lit(end).cast("timestamp").alias("end"))
    return hourly_manifest(b)


def calendar_manifest(spark: SparkSession, year: int, month: int,
                      days: Iterable[int], hours: Iterable[int]) -> DataFrame:
    """Files for ``days`` x ``hours`` of one month, in day-then-hour order.

    Two nested ``explode`` generators (no join) build the grid.
    """
    days, hours = list(days), list(hours)
    base = spark.range(1).select(
        F.explode(F.array(*[F.lit(int(d)) for d in days])).alias("d"),
        F.array(*[F.lit(int(h)) for h in hours]).alias("hs"))
    grid = base.select("d", F.explode("hs").alias("h"))
    ts = F.make_timestamp(F.lit(year), F.lit(month), F.col("d"), F.col("h"), F.lit(0), F.lit(0))
    return _with_patterns(grid.select(ts.alias("file_time"))).orderBy("file_time")


def listing_manifest(listing: DataFrame, text_col: str = "value") -> DataFrame:
    """Distinct dump names found in listing text, sorted (``grep -o | sort | uniq``)."""
    names = F.regexp_extract_all(F.col(text_col), F.lit(LISTED_NAME_REGEX), F.lit(0))
    return (listing.select(F.explode(names).alias("file_name"))
            .distinct()
            .orderBy("file_name"))


def full_location(name: Column | str, base: str) -> Column:
    """``pageviews-YYYYMMDD-HH0000.gz`` -> ``{base}YYYY/YYYY-MM/pageviews-…gz``."""
    name = F.col(name) if isinstance(name, str) else name
    return F.regexp_replace(name, NAME_TO_LOCATION_REGEX, base + NAME_TO_LOCATION_TEMPLATE)
