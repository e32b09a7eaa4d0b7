"""Load ledger: append-only file outcomes and the views over them.

Rows are never updated: each attempt appends one and the
current state of a file is its newest row (``INSERT OR REPLACE`` semantics
without MERGE); a row of status ``epoch`` starts anew. All views are aggregates, so they scale with the number of
files, not rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow import schemas as S
from pageflow.operators.maintain import keep_latest
from pageflow.plans.swap import current_frame, file_count, replace_frame


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger table, or an empty one with the fixed schema if absent."""
    return current_frame(spark, path, S.LEDGER)


#: Files that the ledger's folder may hold before they are put together.
LEDGER_FILES = 200


def append_ledger(rows: DataFrame, path: str) -> None:
    """L5 (write side): append attempt rows, and put the files together when there are many of them."""
    rows.select(*[F.col(f.name).cast(f.dataType) for f in S.LEDGER.fields]).coalesce(1).write.mode("append").parquet(path)
    if file_count(rows.sparkSession, path) > LEDGER_FILES:
        compact_ledger(rows.sparkSession, path)


def compact_ledger(spark: SparkSession, path: str) -> None:
    """Rewrites the ledger, with its whole history, as one file for each million rows or so.

    Whoever appends holds the load's lease (``plans.ingest``), so nothing is added meanwhile.
    """
    rows = read_ledger(spark, path)
    replace_frame(rows.coalesce(max(1, rows.count() // 1_000_000)), path)


#: Status of a row that starts a new epoch: files count as loaded only by later rows.
EPOCH = "epoch"


def new_epoch(spark: SparkSession, path: str, now: _dt.datetime | None = None) -> None:
    """From now on every file is pending again; the history stays. It begins after the newest row, whatever the clock says."""
    ts = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    newest = read_ledger(spark, path).agg(F.max("processed_at").alias("newest"))
    append_ledger(newest.select(
        F.lit("").alias("file_pattern"), F.lit(0).alias("rows_inserted"), F.greatest(ts, "newest").alias("processed_at"),
        F.lit(EPOCH).alias("status"), F.lit(None).alias("error_message"), F.lit("").alias("run_id")), path)


def attempts(ledger: DataFrame) -> DataFrame:
    """All attempts of all epochs."""
    return ledger.where(F.col("status") != EPOCH)


def ledger_latest(ledger: DataFrame) -> DataFrame:
    """L5 (read side): newest row per ``file_pattern`` of the current epoch (ties broken by run_id, status)."""
    began = ledger.agg(F.max(F.when(F.col("status") == EPOCH, F.col("processed_at")))).scalar()
    now = attempts(ledger).where(F.coalesce(F.col("processed_at") > began, F.lit(True)))
    return keep_latest(now, ["file_pattern"], "processed_at").select(*[f.name for f in S.LEDGER.fields])


def processed_files(ledger: DataFrame) -> DataFrame:
    """L6 (P17): files whose current state is ``success``."""
    return ledger_latest(ledger).where(F.col("status") == "success").select("file_pattern")


def pending_files(manifest: DataFrame, ledger: DataFrame) -> DataFrame:
    """Manifest minus files already loaded successfully (failed ones are retried, B8).

    The loaded-file set grows with the archive (one row per hour, ~9k a
    year); Spark broadcasts it while it measures small, else shuffles.
    """
    return manifest.join(processed_files(ledger), "file_pattern", "left_anti")


def status_rollup(ledger: DataFrame) -> DataFrame:
    """Files and rows per current status."""
    return (ledger_latest(ledger).groupBy("status")
            .agg(F.count(F.lit(1)).alias("files"), F.sum("rows_inserted").alias("total_rows"))
            .orderBy("status"))


def latest_loads(ledger: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most recent attempts."""
    return (attempts(ledger).select("file_pattern", "rows_inserted", "processed_at", "status")
            .orderBy(F.desc("processed_at"), F.asc("file_pattern"), F.asc("status"))
            .limit(k))


def run_summary(ledger: DataFrame, run_id: str | None = None) -> DataFrame:
    """Attempted / succeeded / failed files and rows inserted per run."""
    df = attempts(ledger)
    df = df if run_id is None else df.where(F.col("run_id") == run_id)
    return (df.groupBy("run_id")
            .agg(F.count(F.lit(1)).alias("attempted"),
                 F.count_if(F.col("status") == "success").alias("succeeded"),
                 F.count_if(F.col("status") == "failed").alias("failed"),
                 F.sum(F.when(F.col("status") == "success", F.col("rows_inserted")).otherwise(0))
                 .alias("rows_inserted"))
            .orderBy("run_id"))
