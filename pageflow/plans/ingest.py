"""Set-based load of hourly dumps with a ledger.

A run reads its pending files in batches of one folder (a month), each batch
in one Spark job (parallelism = number of gzip files), parses and filters them
where they are read, and stages only the kept rows in the shared checkpoint
folder. Per-file outcomes, quarantine, the fact write and the ledger rows run
on those staged rows, so a lost executor never forces a re-read of the dumps;
the stage is removed when the run is over.

Idempotent replay (B6): the fact is partitioned by month ``ym`` and source file
``src_file`` and the writer itself asks for dynamic overwrite, so re-loading a
file replaces exactly its rows, whatever the session says, and a replay that
keeps nothing removes them. ``mode='append'`` keeps the reference's basic
behaviour of plain appends (B3).

Failure isolation (L4): a file fails when any kept row has an unusable count
or its name carries no hour; missing files fail alone; a file that Spark says it
can't read is set aside with Spark's message and the rest of its batch goes
on. Any other error stops the run: it is not the files' fault.
"""

from __future__ import annotations

import datetime as _dt
import re
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow import schemas as S
from pageflow.functions import parse as P
from pageflow.operators import ledger as L
from pageflow.operators.ingest_ops import flag_lenient, parse_strict
from pageflow.plans.swap import Lease
from pageflow.plans.versions import SnapshotTable
from pageflow.session import drop_path, path_exists, read_or_empty, scratch_path
from pageflow.sources.dumps import read_named_lines

STAGED_COLS = ["file_name", "time", "project", "subproject", "path", "hits", "bad"]
STAGED_ROW = "file_name STRING, time TIMESTAMP, project STRING, subproject STRING, path STRING, hits BIGINT"


def _existing(spark: SparkSession, paths: list[str]) -> tuple[list[str], list[str]]:
    """Split ``paths`` into present and missing with one listing per parent folder (a month)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    by_dir: dict[str, list[str]] = {}
    for p in paths:
        by_dir.setdefault(p.rsplit("/", 1)[0], []).append(p)
    ok, missing = [], []
    for d, ps in by_dir.items():
        hd = jvm.org.apache.hadoop.fs.Path(d)
        fs = hd.getFileSystem(conf)
        names = {st.getPath().getName() for st in fs.listStatus(hd)} if fs.exists(hd) else set()
        for p in ps:
            (ok if p.rsplit("/", 1)[-1] in names else missing).append(p)
    return ok, missing


def _stage(spark: SparkSession, paths: list[str], keywords: DataFrame | None, out: str,
           projects, parser: str) -> DataFrame:
    dirs = sorted({p.rsplit("/", 1)[0] for p in paths})
    lines = read_named_lines(spark, dirs, [p.rsplit("/", 1)[-1] for p in paths])
    if parser == "strict":
        rows = parse_strict(lines, passthrough=["file_name"]).withColumn(
            "bad", F.col("hits").isNull() | F.col("time").isNull())
        if keywords is not None:
            kw = keywords.select(F.col("keyword")).distinct()
            rows = rows.join(kw, rows["path"] == kw["keyword"], "left_semi")
        if projects is not None:
            rows = rows.where(F.col("project").isin(list(projects)))
    elif parser == "history":
        rows = flag_lenient(lines, keywords, projects=projects, drop_unknown_title=False).where("kept")
    else:
        rows = flag_lenient(lines, keywords, projects=projects).where("kept")
    rows.select(*STAGED_COLS).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


#: How Spark names the file of a failed read.
UNREADABLE = re.compile(r"FAILED_READ_FILE.*?while reading file \S*?([^/\s]+?)\.?\s", re.S)


def _stage_isolating(spark, paths, keywords, root, projects, parser, errors: dict[str, str]) -> list[str]:
    """Stage ``paths`` folder by folder; a file that can't be read is put into ``errors`` and left out.

    What is left of a batch with such a file goes on in halves, so a half without
    another is done at once: each file is read at most once for every halving,
    however many files of the folder are bad.
    """
    folders: dict[str, list[str]] = {}
    for p in paths:
        folders.setdefault(p.rsplit("/", 1)[0], []).append(p)
    out = []
    for batch in folders.values():
        todo = [batch]
        while todo:
            batch = todo.pop()
            stage = f"{root}/s-{uuid.uuid4().hex[:8]}"
            try:
                _stage(spark, batch, keywords, stage, projects, parser)
                out.append(stage)
            except Exception as e:  # noqa: BLE001 - raised again unless it names one of the files
                said = str(e)
                named = UNREADABLE.search(said)
                bad = [p for p in batch if named and p.endswith("/" + named[1])]
                if not bad:
                    raise
                errors.update({p: said.strip() for p in bad})
                drop_path(spark, stage)
                rest = [p for p in batch if p not in bad]
                half = len(rest) // 2
                todo += [part for part in (rest[half:], rest[:half]) if part]
    return out


def ingest(spark: SparkSession, base: str, manifest: DataFrame, fact_path: str | SnapshotTable, ledger_path: str,
           keywords: DataFrame | None, mode: str = "incremental",
           projects: Iterable[str] | None = P.DEFAULT_PROJECTS, parser: str = "lenient",
           run_id: str | None = None, now: _dt.datetime | None = None) -> dict:
    """Load the manifest's pending files into the fact table and append their outcomes to the ledger.

    A lease beside the ledger keeps loaders apart (B7): a second one waits, then
    finds in the ledger what the first has loaded.
    """
    with Lease(spark, f"{ledger_path.rstrip('/')}.lease"):
        return _ingest(spark, base, manifest, fact_path, ledger_path, keywords, mode, projects, parser, run_id, now)


def _ingest(spark, base, manifest, fact_path, ledger_path, keywords, mode, projects, parser, run_id, now) -> dict:
    """The load itself.

    ``manifest`` needs ``file_pattern`` (relative to ``base``). ``parser``:
    ``lenient`` (the keyword load), ``strict`` (5-group regex of the
    full-history loader) or ``history`` (lenient tokens, no unknown-title
    filter; with ``keywords=None, projects=None`` the unfiltered W3 load).
    Returns counts of attempted / succeeded / failed files and rows inserted (B7, B9).
    """
    run_id = run_id or uuid.uuid4().hex[:12]
    ledger = L.read_ledger(spark, ledger_path)
    todo = L.pending_files(manifest.select("file_pattern"), ledger) if mode == "incremental" \
        else manifest.select("file_pattern")
    patterns = sorted(r.file_pattern for r in todo.distinct().collect())  # file list, not data
    if not patterns:
        return {"run_id": run_id, "attempted": 0, "succeeded": 0, "failed": 0, "rows_inserted": 0}

    root = base.rstrip("/")
    full = {p: f"{root}/{p}" for p in patterns}
    present, missing = _existing(spark, list(full.values()))
    errors = {p: "file not found" for p in missing}  # by full path
    stage_root = scratch_path(spark, f"stage-{run_id}")
    staged_dirs = _stage_isolating(spark, present, keywords, stage_root, projects, parser, errors)
    errors = {p: errors[full[p]] for p in patterns if full[p] in errors}

    attempts = spark.createDataFrame(
        [(p, full[p].rsplit("/", 1)[-1], errors.get(p)) for p in patterns],
        "file_pattern STRING, file_name STRING, error_message STRING")
    staged = spark.read.parquet(*staged_dirs) if staged_dirs else None
    try:
        return commit(spark, attempts, staged, fact_path, ledger_path, mode, run_id, now)
    finally:
        drop_path(spark, stage_root)


def commit(spark: SparkSession, attempts: DataFrame, staged: DataFrame | None, fact_path: str | SnapshotTable,
           ledger_path: str, mode: str = "incremental", run_id: str | None = None,
           now: _dt.datetime | None = None) -> dict:
    """Quarantine, fact write and ledger append for one run.

    ``attempts``: ``file_pattern, file_name, error_message`` (one row per file
    tried); ``staged``: kept rows with ``file_name`` and ``bad``. A
    :class:`SnapshotTable` in place of the fact's path takes the files in one version.
    """
    run_id = run_id or uuid.uuid4().hex[:12]
    ts = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    if staged is not None:
        per_file = (staged.groupBy("file_name")
                    .agg(F.count_if(~F.col("bad")).alias("rows_ok"), F.count_if("bad").alias("bad_rows")))
    else:
        per_file = spark.createDataFrame([], "file_name STRING, rows_ok BIGINT, bad_rows BIGINT")
    outcome = (attempts.join(per_file, "file_name", "left")
               .select("file_pattern", "file_name",
                       F.coalesce("rows_ok", F.lit(0)).alias("rows_ok"),
                       F.coalesce("bad_rows", F.lit(0)).alias("bad_rows"),
                       F.col("error_message")))
    failed_flag = F.col("error_message").isNotNull() | (F.col("bad_rows") > 0)
    outcome = outcome.select(
        "file_pattern", "file_name", "rows_ok", "bad_rows",
        F.when(failed_flag, F.lit("failed")).otherwise(F.lit("success")).alias("status"),
        F.coalesce(F.col("error_message"),
                   F.when(F.col("bad_rows") > 0,
                          F.concat(F.col("bad_rows").cast("string"), F.lit(" rows with unusable counts"))))
        .alias("error_message"))
    # Materialise the (per-file, small) outcome once so the write and the ledger agree.
    out_path = scratch_path(spark, f"outcome-{run_id}")
    outcome.write.mode("overwrite").parquet(out_path)
    outcome = spark.read.parquet(out_path)

    done = outcome.where(F.col("status") == "success")
    good = None if staged is None else staged.join(done.select("file_name"), "file_name", "left_semi").drop("bad")
    if isinstance(fact_path, SnapshotTable):
        if mode == "append":
            raise ValueError("a snapshot table replaces source files; it can't append them twice")
        if not done.isEmpty():
            fact_path.load(good if good is not None else spark.createDataFrame([], STAGED_ROW), done.select("file_name"))
    elif good is not None:
        write_fact(good, fact_path, append=(mode == "append"))
    if mode != "append" and not isinstance(fact_path, SnapshotTable):
        for r in done.where(F.col("rows_ok") == 0).select("file_name").collect():  # file names, not data
            _drop_file_rows(spark, fact_path, r["file_name"])

    L.append_ledger(outcome.select(
        "file_pattern",
        F.when(F.col("status") == "success", F.col("rows_ok")).otherwise(F.lit(0)).alias("rows_inserted"),
        ts.alias("processed_at"), "status", "error_message", F.lit(run_id).alias("run_id")), ledger_path)

    summary = outcome.agg(F.count(F.lit(1)).alias("attempted"),
                          F.count_if(F.col("status") == "success").alias("succeeded"),
                          F.count_if(F.col("status") == "failed").alias("failed"),
                          F.sum(F.when(F.col("status") == "success", F.col("rows_ok")).otherwise(0))
                          .alias("rows_inserted")).first()
    drop_path(spark, out_path)
    return {"run_id": run_id, **{k: int(summary[k] or 0) for k in
                                 ("attempted", "succeeded", "failed", "rows_inserted")}}


FACT_PARTITIONS = ["ym", "src_file"]


def _drop_file_rows(spark: SparkSession, fact_path: str, file_name: str) -> None:
    """Removes what an earlier load of the file left, when a replay keeps no row of it."""
    stamp = re.search(P.FILE_STAMP_REGEX, file_name)
    if stamp:
        folder = f"{fact_path}/ym={stamp[1][:6]}/src_file={file_name}"
        if path_exists(spark, folder):
            drop_path(spark, folder)


def write_fact(rows: DataFrame, fact_path: str, append: bool = False) -> None:
    """Add ``ingestion_date``, ``ym``, ``src_file``; files sorted by ``path, time`` in each partition.

    Rows are written by the tasks that hold them, without a shuffle: staged
    rows of one dump come from one task's file, and a large one is read, and so
    written, in several splits. The sort leads with the partition columns, as
    the partitioned writer wants it, so it does not sort again and files stay
    ordered by ``path`` for row-group skipping. Rows without a ``file_name``
    are filed under the dump of their hour; as they don't come staged by dump, each task
    may hold rows of every hour, so they are dealt by dump first.
    """
    named = F.col("file_name") if "file_name" in rows.columns else F.concat(
        F.lit("pageviews-"), F.date_format("time", P.FILE_STAMP_FORMAT), F.lit(".gz"))
    out = (rows.withColumn("ingestion_date", F.current_date()).withColumn("ym", P.ym(F.col("time")))
           .withColumn("src_file", named).drop("file_name"))
    if "file_name" not in rows.columns:
        # a number of its own, since AQE would merge small dumps into one task, which then writes all their folders
        out = out.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *FACT_PARTITIONS)
    (out.sortWithinPartitions(*FACT_PARTITIONS, "path", "time")
     .write.mode("append" if append else "overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*FACT_PARTITIONS).parquet(fact_path))


def read_fact(spark: SparkSession, fact_path: str) -> DataFrame:
    """The fact table with its partition columns (empty if nothing is loaded yet)."""
    return read_or_empty(spark, fact_path, S.FACT)
