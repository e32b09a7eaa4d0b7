"""Recurring load of newly arrived dump files with Structured Streaming.

The stream is one of file names: a ``binaryFile`` source whose content is never
read tells in its checkpoint which files were seen, and each micro-batch hands
its file list to the batch loader (``plans.ingest``). So quarantine, files that
can't be read, replay and the ledger work as in a batch run: a corrupt file is
recorded and the others load, and a micro-batch that is run again finds its
files done in the ledger. ``trigger(availableNow=True)`` takes everything that
has arrived and stops, so a scheduled run loads exactly the new hours.

Files that fail stay marked as seen by the stream's checkpoint. With
``retry_failed`` a scheduled run has a second source, the ledger itself: rows
of failed files that were added since the last run are taken up once
more, so a file is tried again once a run, and its place in the checkpoint is what makes it
wait. Without it their retry is the batch loader's job (its manifest
anti-joins only ``success`` rows). Every file of a micro-batch gets a ledger
row, including files without a kept row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pageflow import schemas as S
from pageflow.functions import parse as P
from pageflow.plans.ingest import ingest
from pageflow.session import scratch_path

# Fixed value: archive-relative location of a dump inside any base folder.
RELATIVE_PATTERN_REGEX = r"(\d{4}/\d{4}-\d{2}/pageviews-[^/]+)$"

# Fixed value: the columns of Spark's binaryFile source.
BINARY_FILE = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def dump_stream(spark: SparkSession, base: str, glob: str = "pageviews-*.gz",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming names of the dumps below ``base``: ``file_pattern``, relative to it."""
    r = (spark.readStream.format("binaryFile").schema(BINARY_FILE).option("recursiveFileLookup", "true")
         .option("pathGlobFilter", glob))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    path = F.col("path")
    rel = F.regexp_extract(path, RELATIVE_PATTERN_REGEX, 1)
    return r.load(base).select(F.when(rel != "", rel).otherwise(F.substring_index(path, "/", -1)).alias("file_pattern"))


def failed_stream(spark: SparkSession, ledger_path: str) -> DataFrame:
    """Streaming names of files for which a failure was added to the ledger: ``file_pattern``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(ledger_path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)
    return spark.readStream.schema(S.LEDGER).parquet(ledger_path).where("status = 'failed'").select("file_pattern")


def start_stream_load(spark: SparkSession, base: str, fact_path: str, ledger_path: str,
                      keywords: DataFrame, checkpoint: str | None = None,
                      projects: Iterable[str] | None = P.DEFAULT_PROJECTS,
                      available_now: bool = True,
                      max_files_per_trigger: int | None = None, retry_failed: bool = False) -> StreamingQuery:
    """Start the load stream; with ``available_now`` it stops after the files present now.

    ``max_files_per_trigger`` bounds each micro-batch (a backlog of a year of
    hours is then loaded as a series of bounded batches). ``retry_failed`` needs
    ``available_now``: a stream that never stops would try a broken file without a pause.
    """
    if retry_failed and not available_now:
        raise ValueError("failed files are tried again by scheduled runs only")
    checkpoint = checkpoint or scratch_path(spark, "stream-ckpt")
    name = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:8]

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        ingest(batch.sparkSession, base, batch, fact_path, ledger_path, keywords, mode="incremental",
               projects=projects, run_id=f"stream-{name}-{epoch_id}")

    names = dump_stream(spark, base, max_files_per_trigger=max_files_per_trigger)
    if retry_failed:
        names = names.unionByName(failed_stream(spark, ledger_path))
    w = names.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def run_stream_load(spark: SparkSession, base: str, fact_path: str, ledger_path: str,
                    keywords: DataFrame, checkpoint: str | None = None,
                    projects: Iterable[str] | None = P.DEFAULT_PROJECTS,
                    max_files_per_trigger: int | None = None, retry_failed: bool = False) -> None:
    """One scheduled run: load all newly arrived files (and try those again that failed before), then return."""
    q = start_stream_load(spark, base, fact_path, ledger_path, keywords, checkpoint, projects, True,
                          max_files_per_trigger, retry_failed)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
