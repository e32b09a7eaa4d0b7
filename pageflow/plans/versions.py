"""Versions of a stored table behind an atomic pointer.

:class:`VersionLog` numbers the states of anything that is stored in folders:
the new state is written first, under a name of its own, then a small file
with the next number is renamed into place. The rename fails if the number is
taken, so of two writers one has to look again, and a crash at any moment
leaves the last number as it was. (The file system must rename without
overwriting, as HDFS does.)

:class:`SnapshotTable` is a fact table on top of it. Data folders are written
once and never changed; a version is four small Parquet tables that Spark
reads and joins like any other:

* ``files``: the live data files with rows and the range of ``path`` and ``time``,
  the sparse index by which reads are pruned;
* ``hours``: which batch holds which source file;
* ``dead``: source files whose rows in an older batch no longer count, because a
  later batch replaced them; compaction removes these rows for good;
* ``totals``: where each batch's page totals per month lie, so that a summary
  adds them up instead of reading the fact again.

The driver handles file names and counts, never rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow import schemas as S
from pageflow.functions import parse as P
from pageflow.operators import reports as R
from pageflow.operators.maintain import keep_latest
from pageflow.plans.swap import current_frame, replace_frame  # noqa: F401 - part of this module's interface
from pageflow.session import drop_path, scratch_path


class Conflict(RuntimeError):
    """The table changed in a way that the work at hand doesn't allow for."""


class VersionLog:
    """Numbered states below ``root/_versions``; the highest number is the current one."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, f"{root.rstrip('/')}/_versions"

    def _path(self, name: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        p, fs = self._path("")
        names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n) for n in names if n.isdigit())

    def read(self, number: int) -> dict:
        p, fs = self._path(f"{number:010d}")
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def current(self) -> tuple[int, dict]:
        """Number and content of the newest state; (0, {}) before the first."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (0, {})

    def point(self, number: int, content: dict) -> bool:
        """Makes ``content`` state ``number``; False if another writer has that number already."""
        jvm = self.spark._jvm
        p, fs = self._path(f"{number:010d}")
        if fs.exists(p):
            return False
        draft, _ = self._path(f"_draft-{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        stream.writeBytes(json.dumps(content))
        stream.close()
        keep = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), self.spark._jsc.hadoopConfiguration()).rename(draft, p, keep)
        except Exception:  # noqa: BLE001 - raised again unless the number is taken now
            fs.delete(draft, False)
            if fs.exists(p):
                return False
            raise
        return True

    def forget(self, number: int) -> None:
        p, fs = self._path(f"{number:010d}")
        fs.delete(p, False)


# The tables of a version. ``path`` and ``folder`` are relative to the table's root.
PARTS = {
    "files": "path STRING, batch STRING, ym INT, rows BIGINT, min_path STRING, max_path STRING, min_time TIMESTAMP, max_time TIMESTAMP",
    "hours": "src_file STRING, batch STRING, ym INT",
    "dead": "batch STRING, src_file STRING, ym INT",
    "totals": "batch STRING, ym INT, gen STRING",
}
DATA = S.T.StructType([f for f in S.FACT.fields if f.name != "ym"] + [
    S.T.StructField("batch", S.T.StringType()), S.T.StructField("ym", S.T.IntegerType())])
TOTALS = "path STRING, total_hits BIGINT, records BIGINT, latest_time TIMESTAMP, gen STRING, batch STRING, ym INT"
#: Tasks that write a state: a row a file, an hour or a batch and month.
STATE_TASKS = 4
#: Let the scan skip row groups that can't hold a page, also where their range of pages can't tell.
BLOOM = {"parquet.bloom.filter.enabled#path": "true", "parquet.bloom.filter.expected.ndv#path": "100000"}


def _written(rows: DataFrame) -> DataFrame:
    at = scratch_path(rows.sparkSession, "merge-rows")
    rows.write.parquet(at)
    return rows.sparkSession.read.parquet(at)


@dataclass
class State:
    number: int
    content: dict
    parts: dict[str, DataFrame]


class SnapshotTable:
    """A fact table with versions, replaced by source file, compacted by month, pruned by page and time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = VersionLog(spark, self.root)

    # -- versions ---------------------------------------------------------------------

    def state(self, number: int | None = None) -> State:
        if number is None:
            number, content = self.log.current()
        else:
            content = self.log.read(number) if number else {}
        parts = {name: self.spark.read.schema(ddl).parquet(f"{self.root}/{content['folder']}/part={name}")
                 if content.get(name) else self.spark.createDataFrame([], ddl) for name, ddl in PARTS.items()}
        return State(number, content, parts)

    def _commit(self, change: Callable[[State], dict[str, DataFrame]]) -> int:
        """Applies ``change`` to the newest state until nobody else got in between."""
        while True:
            base = self.state()
            folder = f"_states/{uuid.uuid4().hex}"
            made = change(base)
            rows = [made[name].withColumn("part", F.lit(name)) for name in PARTS]
            at = f"{self.root}/{folder}"
            reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows).coalesce(STATE_TASKS).write.partitionBy("part").parquet(at)
            schema = "part STRING, " + ", ".join(dict.fromkeys(c for ddl in PARTS.values() for c in ddl.split(", ")))
            counts = {r["part"]: r["count"] for r in self.spark.read.schema(schema).parquet(at).groupBy("part").count().collect()}
            if self.log.point(base.number + 1, {"folder": folder, **counts}):
                return base.number + 1
            drop_path(self.spark, f"{self.root}/{folder}")

    # -- reading ----------------------------------------------------------------------

    def live_files(self, page: str | None = None, since=None, until=None, state: State | None = None) -> DataFrame:
        """The files that can hold rows of ``page`` and of times in [since, until]."""
        files = (state or self.state()).parts["files"]
        if page is not None:
            files = files.where((F.col("min_path") <= F.lit(page)) & (F.col("max_path") >= F.lit(page)))
        if since is not None:
            files = files.where(F.col("max_time") >= F.lit(since).cast("timestamp"))
        if until is not None:
            files = files.where(F.col("min_time") <= F.lit(until).cast("timestamp"))
        return files

    def _rows(self, files: DataFrame, state: State) -> DataFrame:
        """Rows of the named files that count, with their batch."""
        paths = sorted(f"{self.root}/data/{r['path']}" for r in files.select("path").collect())  # names, as any scan lists them
        if not paths:
            return self.spark.createDataFrame([], DATA)
        rows = self.spark.read.schema(DATA).option("basePath", f"{self.root}/data").parquet(*paths)
        if state.content.get("dead"):
            rows = rows.join(state.parts["dead"].select("batch", "src_file"), ["batch", "src_file"], "left_anti")
        return rows

    def read(self, number: int | None = None, page: str | None = None, since=None, until=None) -> DataFrame:
        """The fact (of an older version too), reading only files that the index doesn't rule out."""
        state = self.state(number)
        rows = self._rows(self.live_files(page, since, until, state), state)
        if page is not None:
            rows = rows.where(F.col("path") == F.lit(page))
        if since is not None:
            rows = rows.where(F.col("time") >= F.lit(since).cast("timestamp"))
        if until is not None:
            rows = rows.where(F.col("time") <= F.lit(until).cast("timestamp"))
        return rows.select(*S.FACT.names)

    def page_totals(self) -> DataFrame:
        """R10's first aggregate, ``path, total_hits, records, latest_time``, from the batches' totals."""
        rows = self.state().parts["totals"].select("gen", "batch", "ym").collect()  # names
        if not rows:
            return self.spark.createDataFrame([], TOTALS).drop("gen", "batch", "ym")
        paths = sorted(f"{self.root}/totals/gen={r['gen']}/batch={r['batch']}/ym={r['ym']}" for r in rows)
        totals = self.spark.read.schema(TOTALS).option("basePath", f"{self.root}/totals").parquet(*paths)
        return totals.groupBy("path").agg(F.sum("total_hits").alias("total_hits"), F.sum("records").alias("records"),
                                          F.max("latest_time").alias("latest_time"))

    # -- writing ----------------------------------------------------------------------

    def _write(self, rows: DataFrame, batch: str) -> DataFrame:
        """Writes one batch and returns its ``files`` rows, with the ranges as they are stored."""
        at = f"{self.root}/data/batch={batch}"
        (rows.select(*[F.col(f.name).cast(f.dataType) for f in S.FACT.fields]).sortWithinPartitions("ym", "path", "time")
         .write.options(**BLOOM).partitionBy("ym").parquet(at))
        stored = self.spark.read.schema(DATA).option("basePath", f"{self.root}/data").parquet(at)
        found = stored.groupBy(F.substring_index("_metadata.file_path", "/data/", -1).alias("path"), "batch", "ym")
        ranges = found.agg(F.count("*").alias("rows"), F.min("path").alias("min_path"), F.max("path").alias("max_path"),
                           F.min("time").alias("min_time"), F.max("time").alias("max_time"))
        at = f"{self.root}/_states/files-{batch}"
        ranges.coalesce(STATE_TASKS).write.parquet(at)
        return self.spark.read.schema(PARTS["files"]).parquet(at)

    def _totals(self, rows: DataFrame) -> DataFrame:
        """Stores page totals per batch and month of ``rows``; returns their ``totals`` rows."""
        gen = uuid.uuid4().hex[:12]
        at = f"{self.root}/totals/gen={gen}"
        (rows.groupBy("batch", "ym", "path").agg(F.sum("hits").alias("total_hits"), F.count("*").alias("records"), F.max("time").alias("latest_time"))
         .write.partitionBy("batch", "ym").parquet(at))
        stored = self.spark.read.schema(TOTALS).option("basePath", f"{self.root}/totals").parquet(at)
        return stored.select("batch", "ym", "gen").distinct()

    def load(self, rows: DataFrame, src_files: DataFrame) -> int:
        """Replaces what the table has of the named source files by ``rows``; returns the new version.

        ``src_files`` has a ``file_name`` for every file that was read, also
        those without rows. Loads of different files can run side by side; of two loads of one
        file the later commit counts.
        """
        batch = uuid.uuid4().hex[:12]
        name = "src_file" if "src_file" in rows.columns else "file_name"
        rows = rows.withColumn("src_file", F.col(name)).withColumn("ym", P.ym(F.col("time")))
        if "ingestion_date" not in rows.columns:
            rows = rows.withColumn("ingestion_date", F.current_date())
        new = self._write(rows, batch)
        stamped = src_files.select(F.col("file_name").alias("src_file")).distinct()
        stamped = stamped.withColumn("ym", P.ym(P.time_from_file_name(F.col("src_file"))))
        own = self._totals(self.spark.read.schema(DATA).option("basePath", f"{self.root}/data")
                           .parquet(f"{self.root}/data/batch={batch}")) if not new.isEmpty() else None

        def change(base: State) -> dict[str, DataFrame]:
            old = base.parts
            replaced = old["hours"].join(stamped.select("src_file"), "src_file", "left_semi")
            dead = old["dead"].unionByName(replaced.select("batch", "src_file", "ym"))
            touched = replaced.select("batch", "ym").distinct()
            totals = old["totals"].join(touched, ["batch", "ym"], "left_anti")
            if base.number and not touched.isEmpty():
                left = self._rows(old["files"].join(touched, ["batch", "ym"], "left_semi"), base)
                left = left.join(replaced.select("batch", "src_file"), ["batch", "src_file"], "left_anti")
                totals = totals.unionByName(self._totals(left))
            if own is not None:
                totals = totals.unionByName(own)
            hours = old["hours"].join(stamped.select("src_file"), "src_file", "left_anti")
            hours = hours.unionByName(stamped.withColumn("batch", F.lit(batch)))
            return {"files": old["files"].unionByName(new), "hours": hours, "dead": dead, "totals": totals}

        return self._commit(change)

    def merge_latest(self, rows: DataFrame, keys: Sequence[str] = S.NATURAL_KEY, version_col: str = "ingestion_date") -> int:
        """M3 by parts: only source files that ``rows`` has are read, merged and written again; the others stay as they are.

        The hour is a part of the key, so a key never spans two source files
        and the result equals :func:`keep_latest` over everything.
        """
        if "time" not in keys:
            raise ValueError("a key without the hour can have rows in several source files")
        rows = _written(rows)  # read several times below
        touched = rows.select("src_file").distinct()
        months = rows.select(P.ym(F.col("time")).alias("ym")).distinct()
        state = self.state()
        at = state.parts["hours"].join(touched, "src_file", "left_semi").select("batch", "ym").distinct()
        before = self._rows(state.parts["files"].join(months, "ym", "left_semi").join(at, ["batch", "ym"], "left_semi"), state)
        columns = [*keys, "hits", version_col, "src_file"]
        both = before.join(touched, "src_file", "left_semi").select(*columns).unionByName(rows.select(*columns))
        merged = keep_latest(both, keys, version_col)
        return self.load(merged, touched.withColumnRenamed("src_file", "file_name"))

    def compact(self, months: Iterable[int] | None = None, before: int | None = None, attempts: int = 5) -> int:
        """M4: rewrites whole months (given, or all before ``before``) as few files ordered by page, without dead rows.

        Readers see the old files until the pointer moves. If an hour of these
        months is loaded meanwhile, the rewrite is thrown away and done again.
        """
        for _ in range(attempts):
            base = self.state()
            chosen = F.col("ym") < before if before is not None else F.col("ym").isin([int(m) for m in months or []])
            batch = uuid.uuid4().hex[:12]
            rows = self._rows(base.parts["files"].where(chosen), base).drop("batch")
            new = self._write(rows.repartitionByRange("ym", "path", "time"), batch)
            own = self._totals(self.spark.read.schema(DATA).option("basePath", f"{self.root}/data")
                               .parquet(f"{self.root}/data/batch={batch}")) if not new.isEmpty() else None

            def change(now: State) -> dict[str, DataFrame]:
                seen, here = (s.parts["hours"].where(chosen) for s in (base, now))
                if now.number != base.number and not (seen.exceptAll(here).isEmpty() and here.exceptAll(seen).isEmpty()):
                    raise Conflict("a month changed while it was compacted")
                keep = {k: d.where(~chosen) for k, d in now.parts.items()}
                moved = now.parts["hours"].where(chosen).withColumn("batch", F.lit(batch))
                totals = keep["totals"] if own is None else keep["totals"].unionByName(own)
                return {"files": keep["files"].unionByName(new), "hours": keep["hours"].unionByName(moved.select("src_file", "batch", "ym")),
                        "dead": keep["dead"], "totals": totals}

            try:
                return self._commit(change)
            except Conflict:
                drop_path(self.spark, f"{self.root}/data/batch={batch}")
        raise Conflict(f"the months changed during {attempts} rewrites")

    def truncate(self) -> int:
        """A version without rows; the earlier ones can still be read until :meth:`expire`."""
        return self._commit(lambda base: {name: part.limit(0) for name, part in base.parts.items()})

    def expire(self, keep: int = 1, older_than_seconds: int = 86_400) -> list[str]:
        """Removes older versions and the folders that no kept version names; returns what was removed.

        Folders younger than ``older_than_seconds`` stay, since a writer may be about to commit them.
        """
        numbers = self.log.numbers()
        kept = [self.state(n) for n in numbers[-keep:]]
        live = {s.content["folder"] for s in kept}
        for s in kept:
            live |= {f"data/batch={r['batch']}" for r in s.parts["files"].select("batch").distinct().collect()}
            live |= {f"totals/gen={r['gen']}" for r in s.parts["totals"].select("gen").distinct().collect()}
        for n in numbers[:-keep]:
            self.log.forget(n)
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        now, gone = jvm.java.lang.System.currentTimeMillis(), []
        for kind in ("data", "totals", "_states"):
            p = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}")
            fs = p.getFileSystem(conf)
            for st in fs.listStatus(p) if fs.exists(p) else []:
                name = f"{kind}/{st.getPath().getName()}"
                if name not in live and st.getModificationTime() <= now - 1000 * older_than_seconds:
                    fs.delete(st.getPath(), True)
                    gone.append(name)
        return sorted(gone)

    def summary(self, keywords: DataFrame, **how) -> DataFrame:
        """R10 from the batches' totals."""
        return R.summary_of(self.page_totals(), keywords, **how)
