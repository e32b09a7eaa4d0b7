"""Scans of hourly page-view dumps.

Dumps are gzip text, which is not splittable: read parallelism is the number
of files, so a month of hourly files is ~720 tasks and the full archive is
hundreds of thousands — enough for any cluster. Globs and directory listings
are resolved by Spark's file index, not by the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageflow import schemas as S

# Fixed value: dump lines are single-space separated and quotes are literal.
DUMP_SEP = " "
NO_QUOTE = ""


def _paths(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_lines(spark: SparkSession, paths: str | Sequence[str], path_glob: str | None = None,
               recursive: bool = False) -> DataFrame:
    """Raw lines ``value`` with ``file_name`` and ``file_path`` of their file."""
    r = spark.read.format("text")
    if path_glob:
        r = r.option("pathGlobFilter", path_glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    df = r.load(_paths(paths))
    return df.select("value",
                     F.col("_metadata.file_name").alias("file_name"),
                     F.col("_metadata.file_path").alias("file_path"))


def read_named_lines(spark: SparkSession, dirs: Sequence[str], names: Sequence[str],
                     glob: str = "pageviews-*.gz") -> DataFrame:
    """S1 for a chosen set of files: lines of the files called ``names`` inside ``dirs``.

    The folders are listed once and the ``_metadata.file_name`` predicate
    prunes files before any is opened (probe: a corrupt file outside
    ``names`` is never read), which avoids one root path per file.
    """
    return (read_lines(spark, list(dirs), path_glob=glob)
            .where(F.col("file_name").isin(list(names))))


def _csv(spark: SparkSession, schema: T.StructType | None):
    r = (spark.read.format("csv").option("sep", DUMP_SEP).option("header", "false")
         .option("quote", NO_QUOTE).option("mode", "PERMISSIVE"))
    return r.schema(schema) if schema is not None else r


def read_dump_rows(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """S3: explicit 4-column view ``project, page_title, view_count, bytes_served``.

    Projections and filters on this DataFrame reach the CSV scan
    (``PushedFilters``/``ReadSchema``), as in the reference's pushdown demo.
    """
    return _csv(spark, S.DUMP_ROW).load(_paths(paths))


def read_dump_text(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The same four columns, all as text (for a raw preview)."""
    return _csv(spark, S.DUMP_ROW_TEXT).load(_paths(paths))


def infer_dump_schema(spark: SparkSession, paths: str | Sequence[str],
                      sampling_ratio: float = 1.0) -> DataFrame:
    """Detected schema as rows ``(ordinal, column_name, data_type)``.

    One scan of the all-text view (of a share of its rows with ``sampling_ratio``):
    each task folds its rows into one flag for every column and type, and the
    flags of all tasks into the narrowest type that holds every value.
    """
    df = read_dump_text(spark, paths)
    if sampling_ratio < 1:
        df = df.sample(sampling_ratio)
    return detect_types(df.toDF(*[f"_c{k}" for k in range(len(df.columns))]))


#: Narrowest first; a column in which none of them holds every value, or without values, is a string.
DETECTED_TYPES = ["int", "bigint", "double", "timestamp", "boolean"]


def detect_types(df: DataFrame) -> DataFrame:
    """The narrowest type of each text column, by one aggregate whose size doesn't depend on the rows."""
    def holds(c: str, kind: str):
        return F.every(F.col(f"`{c}`").isNull() | F.col(f"`{c}`").try_cast(kind).isNotNull())

    flags = df.agg(*[F.array(F.count(f"`{c}`") > 0, *[holds(c, kind) for kind in DETECTED_TYPES]).alias(f"f{k}") for k, c in enumerate(df.columns)])

    def narrowest(f):
        kind = F.lit("string")
        for k, name in reversed(list(enumerate(DETECTED_TYPES, 1))):
            kind = F.when(f[k], F.lit(name)).otherwise(kind)
        return F.when(f[0], kind).otherwise(F.lit("string"))

    rows = F.array(*[F.struct(F.lit(k).alias("ordinal"), F.lit(c).alias("column_name"), narrowest(F.col(f"f{k}")).alias("data_type"))
                     for k, c in enumerate(df.columns)])
    return flags.select(F.inline(rows))


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """Article corpus ``id, title, text, url`` from Parquet."""
    return spark.read.parquet(path)
