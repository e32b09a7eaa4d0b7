"""Default job parameters (SURVEY B11: the code's values win over the docs).

A run's calendar is ``days x hours`` of one month; widen it to backfill (L8).
Dump files are read from ``base`` on any Spark-readable file system (an
object store path, HDFS, a shared mount); HTTPS download is not built.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# The reference's default job (3 days x 2 hours = 6 files) and
# the projects it keeps.
DEFAULT_YEAR = 2025
DEFAULT_MONTH = 1
DEFAULT_DAYS = [1, 2, 3]
DEFAULT_HOURS = [0, 1]
DEFAULT_PROJECTS = ("en", "en.m")


@dataclass(frozen=True)
class JobConfig:
    base: str
    year: int = DEFAULT_YEAR
    month: int = DEFAULT_MONTH
    days: list[int] = field(default_factory=lambda: list(DEFAULT_DAYS))
    hours: list[int] = field(default_factory=lambda: list(DEFAULT_HOURS))
    projects: tuple[str, ...] = DEFAULT_PROJECTS

    def manifest(self, spark: SparkSession) -> DataFrame:
        from pageflow.sources.manifest import calendar_manifest
        return calendar_manifest(spark, self.year, self.month, self.days, self.hours)
