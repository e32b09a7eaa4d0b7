"""Write derived dump lines as real hourly gzip dump files.

File-based operators (scans, ingest, stream, quarantine) need files laid out
like the public archive: ``{base}/YYYY/YYYY-MM/pageviews-YYYYMMDD-HH0000.gz``.
Spark writes the gzip text itself (one task per hour after a repartition on
the file name); the driver then only renames each hour's single part file
to its archive name through the Hadoop FileSystem API (metadata, no data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow.session import scratch_path

_CACHE: dict[tuple, str] = {}


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm  # Hadoop FileSystem access from PySpark
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def write_dump_files(spark: SparkSession, lines: DataFrame, base: str,
                     line_col: str = "line", name_col: str = "file_name") -> str:
    """Write ``lines`` as one gzip file per ``name_col`` below ``base``; returns ``base``."""
    staging = base.rstrip("/") + "/_staging"
    (lines.select(F.col(name_col).alias("fname"), F.col(line_col).alias("value"))
     .repartition("fname")
     .write.mode("overwrite").option("compression", "gzip")
     .partitionBy("fname").text(staging))
    jvm, sp, fs = _fs(spark, staging)
    Path = jvm.org.apache.hadoop.fs.Path
    for d in fs.listStatus(sp):
        dname = d.getPath().getName()
        if not d.isDirectory() or not dname.startswith("fname="):
            continue
        fname = dname[len("fname="):]
        parts = [f for f in fs.listStatus(d.getPath()) if f.getPath().getName().startswith("part-")]
        # pageviews-YYYYMMDD-... -> YYYY/YYYY-MM/
        sub = f"{fname[10:14]}/{fname[10:14]}-{fname[14:16]}" if fname.startswith("pageviews-") else "other"
        dest_dir = Path(f"{base.rstrip('/')}/{sub}")
        fs.mkdirs(dest_dir)
        for i, f in enumerate(sorted(parts, key=lambda x: x.getPath().getName())):
            target = fname if i == 0 else fname.replace(".gz", f"-{i}.gz")
            fs.rename(f.getPath(), Path(dest_dir, target))
    fs.delete(sp, True)
    return base


def derived_dump_dir(spark: SparkSession, sf_dir: str, kind: str = "clean") -> str:
    """Dump files of the derived lines for ``sf_dir`` (written once per session).

    ``kind='clean'`` holds the fixture lines; ``kind='dirty'`` adds lines with
    unusable counts to some hours (for quarantine).
    """
    from pageflow.plans import fixtures as X
    key = (id(spark.sparkContext), sf_dir, kind)
    if key not in _CACHE:
        lines = X.lines(spark, sf_dir) if kind == "clean" else X.dirty_lines(spark, sf_dir)
        _CACHE[key] = write_dump_files(spark, lines, scratch_path(spark, f"dumps-{kind}"))
    return _CACHE[key]
