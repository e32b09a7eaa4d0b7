"""End-to-end runs: setup, load, stats, summary.

``run_basic`` mirrors the reference's basic pipeline (reload everything,
append, B3) and ``run_incremental`` its tracked variant (skip loaded files,
retry failed ones, early exit when nothing is pending). Both append per-file
load stats and replace the summary snapshot. Tables live below one root
folder and are registered in the session catalog if absent.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow import schemas as S
from pageflow.operators import dims as D
from pageflow.operators import ledger as L
from pageflow.operators import reports as R
from pageflow.operators.maintain import empty_folder
from pageflow.plans import ingest as IG
from pageflow.plans.swap import Lease, current_frame, replace_frame
from pageflow.plans.versions import SnapshotTable
from pageflow.session import read_or_empty


@dataclass(frozen=True)
class Layout:
    """Locations of the pipeline tables below ``root``."""
    root: str

    @property
    def fact(self) -> str:
        return f"{self.root}/pageviews"

    @property
    def versions(self) -> str:
        return f"{self.root}/pageviews_versions"

    @property
    def keywords(self) -> str:
        return f"{self.root}/keywords"

    @property
    def ledger(self) -> str:
        return f"{self.root}/processed_files"

    @property
    def load_stats(self) -> str:
        return f"{self.root}/pageview_load_stats"

    @property
    def summary(self) -> str:
        return f"{self.root}/summary_statistics"


#: What an INSERT that doesn't name the column puts there.
DEFAULTS = {"ingestion_date": "current_date()", "added_date": "current_date()"}


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + (f" DEFAULT {DEFAULTS[f.name]}" if f.name in DEFAULTS else "")
                     for f in schema.fields)


def create_tables(spark: SparkSession, layout: Layout, db: str = "pageflow") -> None:
    """``CREATE TABLE IF NOT EXISTS … USING parquet`` for every pipeline table (external, at ``layout``)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    jvm = spark._jvm
    for path in (layout.fact, layout.keywords, layout.ledger, layout.load_stats, layout.summary):
        hp = jvm.org.apache.hadoop.fs.Path(path)
        hp.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hp)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.pageviews ({_ddl(S.FACT)}) USING parquet "
              f"PARTITIONED BY ({', '.join(IG.FACT_PARTITIONS)}) LOCATION '{layout.fact}'")
    for name, schema, path in [("keywords", S.KEYWORDS, layout.keywords),
                               ("processed_files", S.LEDGER, layout.ledger),
                               ("pageview_load_stats", S.LOAD_STATS, layout.load_stats),
                               ("summary_statistics", S.SUMMARY, layout.summary)]:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{name} ({_ddl(schema)}) USING parquet LOCATION '{path}'")


def show_partitions(spark: SparkSession, layout: Layout, db: str | None) -> None:
    """Tells the catalog which partitions of the fact there are, so that SQL on the table's name sees them."""
    name = f"{db}.pageviews"
    if db and spark.catalog.tableExists(name):
        where = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()
        if where["data_type"].split(":", 1)[-1].rstrip("/").endswith(layout.fact.split(":", 1)[-1].rstrip("/")):
            spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
            spark.sql(f"REFRESH TABLE {name}")


def truncate_fact(spark: SparkSession, layout: Layout, db: str | None = "pageflow") -> None:
    """Empty the fact table; pair with a fresh ledger to reprocess.

    Spark refuses ``TRUNCATE TABLE`` on external tables, so the table's folder
    is emptied through the Hadoop FileSystem API and the catalog entry refreshed.
    """
    empty_folder(spark, layout.fact)
    show_partitions(spark, layout, db)


def load_stats(ledger: DataFrame, run_id: str | None = None) -> DataFrame:
    """W4 rows of one run: ``date_pattern, rows_inserted, load_timestamp, status, error_message``."""
    df = ledger if run_id is None else ledger.where(F.col("run_id") == run_id)
    return df.select(F.col("file_pattern").alias("date_pattern"), "rows_inserted",
                     F.col("processed_at").alias("load_timestamp"), "status", "error_message")


def write_summary(spark: SparkSession, layout: Layout, keywords: DataFrame, table: SnapshotTable | None = None) -> None:
    """Replace the summary snapshot (R10); an empty fact leaves the last one.

    Computed over the whole fact, or from the page totals of a snapshot table, which
    the loads left, so that only what a load brought is ever counted.
    """
    per_page = table.page_totals() if table is not None else R.page_totals(IG.read_fact(spark, layout.fact))
    if not per_page.isEmpty():
        replace_frame(R.summary_of(per_page, keywords), layout.summary)


def reset(spark: SparkSession, fact: str | SnapshotTable, ledger_path: str, now: _dt.datetime | None = None) -> None:
    """Start again from an empty fact. The ledger keeps its history; a new epoch makes every file pending.

    The epoch comes last: after a crash before it the files still count as
    loaded, so the reset has to be asked for again, and nothing is loaded twice.
    """
    with Lease(spark, f"{ledger_path.rstrip('/')}.lease"):
        if isinstance(fact, SnapshotTable):
            fact.truncate()
        else:
            empty_folder(spark, fact)
        L.new_epoch(spark, ledger_path, now)


def census(spark: SparkSession, layout: Layout) -> DataFrame:
    """Row count of every pipeline table (missing or empty tables count 0)."""
    def read(path, schema):
        return read_or_empty(spark, path, schema)
    return R.table_census(spark, {
        "pageviews": read(layout.fact, S.FACT).unionByName(SnapshotTable(spark, layout.versions).read()),
        "keywords": read(layout.keywords, S.KEYWORDS),
        "processed_files": read(layout.ledger, S.LEDGER),
        "pageview_load_stats": read(layout.load_stats, S.LOAD_STATS),
        "summary_statistics": current_frame(spark, layout.summary, S.SUMMARY),
    })


def _run(spark: SparkSession, base: str, layout: Layout, manifest: DataFrame, mode: str,
         run_id: str | None, now: _dt.datetime | None, db: str | None, versioned: bool = False) -> dict:
    D.seed_keywords(spark, layout.keywords)  # K1, idempotent
    keywords = spark.read.parquet(layout.keywords)
    table = SnapshotTable(spark, layout.versions) if versioned else None
    res = IG.ingest(spark, base, manifest, table or layout.fact, layout.ledger, keywords, mode=mode,
                    run_id=run_id, now=now)
    if res["attempted"]:
        stats = load_stats(L.read_ledger(spark, layout.ledger), res["run_id"])
        stats.select(*[F.col(f.name).cast(f.dataType) for f in S.LOAD_STATS.fields]) \
            .write.mode("append").parquet(layout.load_stats)
        write_summary(spark, layout, keywords, table)
        if table is None:
            show_partitions(spark, layout, db)
    if table is not None:
        res["total_rows"] = table.page_totals().agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]
    else:
        res["total_rows"] = IG.read_fact(spark, layout.fact).count()
    return res


def run_basic(spark: SparkSession, base: str, layout: Layout, manifest: DataFrame,
              run_id: str | None = None, now: _dt.datetime | None = None, db: str | None = "pageflow") -> dict:
    """L2: load every manifest file (always append), stats, summary."""
    return _run(spark, base, layout, manifest, "append", run_id, now, db)


def run_incremental(spark: SparkSession, base: str, layout: Layout, manifest: DataFrame,
                    run_id: str | None = None, now: _dt.datetime | None = None, db: str | None = "pageflow",
                    versioned: bool = False) -> dict:
    """Load only files not yet loaded successfully; a wider manifest backfills missing hours.

    With nothing pending the run ends there: no stats, no new summary. ``versioned`` keeps the
    fact in a snapshot table (``layout.versions``), whose summary needs no scan of it.
    """
    return _run(spark, base, layout, manifest, "incremental", run_id, now, db, versioned)
