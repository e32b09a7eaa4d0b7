"""The snapshot table, its index, merges and totals, epochs, defaults and isolation by halves."""

import datetime as dt
import gzip
import os
import threading

import pytest
from pyspark.sql import functions as F

from pageflow import schemas as S
from pageflow.operators import ledger as L
from pageflow.operators import maintain as M
from pageflow.operators import reports as R
from pageflow.plans import ingest as IG
from pageflow.plans import pipeline as PL
from pageflow.plans import versions as V
from pageflow.plans.swap import Lease
from pageflow.sources import manifest as MF
from pageflow.sources.dumps import detect_types
from pageflow.streaming.filestream import run_stream_load, start_stream_load

ROW = "time TIMESTAMP, project STRING, subproject STRING, path STRING, hits BIGINT, file_name STRING"


def name(hour):
    return f"pageviews-{hour:%Y%m%d-%H}0000.gz"


def hour_rows(spark, hour, pages, hits=1):
    return spark.createDataFrame([(hour, "en", "", p, hits + k, name(hour)) for k, p in enumerate(pages)], ROW)


def files(spark, *hours):
    return spark.createDataFrame([(name(h),) for h in hours], "file_name STRING")


def content(df):
    return sorted((r.time, r.path, r.hits) for r in df.collect())


JAN, JAN2, FEB = dt.datetime(2025, 1, 1, 0), dt.datetime(2025, 1, 1, 1), dt.datetime(2025, 2, 1, 0)
PAGES = [f"P{k:03d}" for k in range(40)]


@pytest.fixture()
def table(spark, workdir):
    t = V.SnapshotTable(spark, f"{workdir}/table")
    for h in (JAN, JAN2, FEB):
        t.load(hour_rows(spark, h, PAGES), files(spark, h))
    return t


def test_replay_in_a_compacted_month(spark, table):
    before = content(table.read())
    assert len(before) == 120
    n = table.compact(before=202502)
    assert content(table.read()) == before
    assert {r.src_file for r in table.read().where("ym = 202501").select("src_file").distinct().collect()} == {name(JAN), name(JAN2)}
    table.load(hour_rows(spark, JAN, ["P001", "new"], 50), files(spark, JAN))
    now = content(table.read())
    assert [x for x in now if x[0] == JAN] == [(JAN, "P001", 50), (JAN, "new", 51)] and len(now) == 82
    assert content(table.read(number=n)) == before  # an older version reads as it was
    table.compact(months=[202501])
    assert content(table.read()) == now and table.state().content.get("dead", 0) == 0
    gone = table.expire(keep=1, older_than_seconds=0)
    assert gone and content(table.read()) == now and len(table.log.numbers()) == 1


def test_a_replay_without_rows_removes_them(spark, table):
    table.load(hour_rows(spark, JAN, []), files(spark, JAN))
    assert {x[0] for x in content(table.read())} == {JAN2, FEB}
    assert table.page_totals().agg(F.sum("records")).first()[0] == 80


def test_a_crash_before_the_pointer_keeps_the_old_version(spark, table, monkeypatch):
    before = content(table.read())

    def crash(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(V.VersionLog, "point", crash)
    with pytest.raises(KeyboardInterrupt):
        table.compact(before=202502)
    with pytest.raises(KeyboardInterrupt):
        table.load(hour_rows(spark, JAN, ["x"]), files(spark, JAN))
    monkeypatch.undo()
    again = V.SnapshotTable(spark, table.root)
    assert content(again.read()) == before
    again.expire(keep=1, older_than_seconds=0)  # what the crash left
    assert content(again.read()) == before


def test_two_writers_lose_nothing(spark, workdir):
    root = f"{workdir}/table"
    hours = [JAN + dt.timedelta(hours=k) for k in range(4)]
    rows = [(hour_rows(spark, h, PAGES[:5]), files(spark, h)) for h in hours]
    failed = []

    def load(mine):
        try:
            for r, f in mine:
                V.SnapshotTable(spark, root).load(r, f)
        except Exception as e:  # noqa: BLE001 - told below
            failed.append(e)

    threads = [threading.Thread(target=load, args=(rows[k::2],)) for k in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    t = V.SnapshotTable(spark, root)
    assert not failed and len(content(t.read())) == 20 and t.log.numbers() == [1, 2, 3, 4]


def test_compaction_starts_over_when_an_hour_comes_in(spark, table, monkeypatch):
    write, late = V.SnapshotTable._write, []

    def slow(self, rows, batch):
        made = write(self, rows, batch)
        if not late:
            late.append(1)
            V.SnapshotTable(spark, self.root).load(hour_rows(spark, JAN, ["late"], 9), files(spark, JAN))
        return made

    monkeypatch.setattr(V.SnapshotTable, "_write", slow)
    table.compact(months=[202501])
    assert [x for x in content(table.read()) if x[0] == JAN] == [(JAN, "late", 9)]
    with pytest.raises(V.Conflict):
        late.clear()
        table.compact(months=[202501], attempts=1)


def test_the_index_names_the_files_that_are_read(spark, workdir):
    t = V.SnapshotTable(spark, f"{workdir}/table")
    for month in (1, 2):
        rows = [(dt.datetime(2025, month, 1, 0), "en", "", f"P{k:05d}", 1, name(dt.datetime(2025, month, 1, 0))) for k in range(4000)]
        t.load(spark.createDataFrame(rows, ROW), files(spark, dt.datetime(2025, month, 1, 0)))
    width = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files a month, as a large one has
    try:
        t.compact(before=202503)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", width)
    everything = t.read().inputFiles()
    assert len(everything) >= 8
    holders = {r.f for r in t.read().where("path = 'P01234'").select(F.input_file_name().alias("f")).distinct().collect()}
    df = t.read(page="P01234")
    assert set(df.inputFiles()) >= holders and len(df.inputFiles()) <= 2 * len(holders) < len(everything)
    assert [r.daily_views for r in R.daily_trend(df, "P01234").collect()] == [1, 1]
    march = t.read(since=dt.datetime(2025, 2, 1))
    assert len(march.inputFiles()) < len(everything) and march.count() == 4000
    assert t.read(page="nothing").count() == 0 and t.read(page="nothing").inputFiles() == []


def test_files_have_bloom_filters(spark, table):
    at = spark._jvm.org.apache.hadoop.fs.Path(table.read().inputFiles()[0])
    conf = spark._jsc.hadoopConfiguration()
    made = spark._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(at, conf)
    reader = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader.open(made)
    try:
        columns = reader.getFooter().getBlocks().get(0).getColumns()
        offsets = {c.getPath().toDotString(): c.getBloomFilterOffset() for c in columns}
    finally:
        reader.close()
    assert offsets["path"] > 0 and offsets["project"] < 0


def test_merge_rewrites_only_the_hours_that_came(spark, workdir):
    t = V.SnapshotTable(spark, f"{workdir}/table")

    def rows(hour, day, pages, hits):
        return hour_rows(spark, hour, pages, hits).withColumnRenamed("file_name", "src_file").withColumn("ingestion_date", F.lit(day).cast("date"))

    first = rows(JAN, "2025-03-01", PAGES, 1).unionByName(rows(JAN2, "2025-03-01", PAGES, 1))
    second = rows(JAN, "2025-03-02", PAGES[:10] + ["new"], 100).unionByName(rows(JAN, "2025-02-01", ["P039"], 999))
    t.merge_latest(first)
    old = {r.path for r in t.live_files().collect()}
    t.merge_latest(second)
    new = {r.path: r.rows for r in t.live_files().collect()}
    assert old <= set(new) and sum(n for p, n in new.items() if p not in old) == 41  # one hour's rows
    want = M.keep_latest(first.unionByName(second).select(*S.NATURAL_KEY, "ingestion_date", "hits"))
    assert content(t.read()) == content(want)


def test_summary_reads_totals_only_and_equals_the_whole(spark, table):
    kw = spark.createDataFrame([(p, "odd" if k % 2 else "even") for k, p in enumerate(PAGES)], "keyword STRING, category STRING")
    for step in (lambda: None, lambda: table.load(hour_rows(spark, JAN, PAGES[5:], 70), files(spark, JAN)), lambda: table.compact(before=202503),
                 lambda: table.load(hour_rows(spark, FEB, ["P001"], 7), files(spark, FEB))):
        step()
        want = R.summary_snapshot(table.read(), kw, stamp_latest=True).first()
        assert table.summary(kw, stamp_latest=True).first() == want
        assert all("/totals/" in f for f in table.page_totals().inputFiles())


def test_summary_swap_survives_a_crash(spark, workdir):
    at = f"{workdir}/summary"
    one, two = (spark.createDataFrame([(k, None, None, None)], S.SUMMARY) for k in (1, 2))
    assert V.current_frame(spark, at, S.SUMMARY).count() == 0
    V.replace_frame(one, at)
    V.replace_frame(two, at)
    assert [r.total_rows for r in spark.read.parquet(at).collect()] == [2] and os.listdir(workdir) == ["summary"]
    os.rename(at, f"{at}._old")  # a crash between the two renames
    assert [r.total_rows for r in V.current_frame(spark, at, S.SUMMARY).collect()] == [2]
    V.replace_frame(one, at)
    assert [r.total_rows for r in V.current_frame(spark, at, S.SUMMARY).collect()] == [1] and os.listdir(workdir) == ["summary"]


def _dumps(workdir, n, bad):
    base = os.path.join(workdir, "dumps")
    for k in range(n):
        h = JAN + dt.timedelta(hours=k)
        d = os.path.join(base, f"{h:%Y}", f"{h:%Y-%m}")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, name(h)), "wb") as f:
            f.write(b"this is not gzip" if k in bad else gzip.compress(b"en DuckDB 3 0\n"))
    return base


def test_bad_files_cost_a_few_reads_of_the_others(spark, workdir, monkeypatch):
    base, bad = _dumps(workdir, 48, {3, 17, 18, 40}), 4
    reads, stage = {}, IG._stage

    def counted(spark, paths, *how):
        for p in paths:
            reads[p] = reads.get(p, 0) + 1
        return stage(spark, paths, *how)

    monkeypatch.setattr(IG, "_stage", counted)
    kw = spark.createDataFrame([("DuckDB", "database")], "keyword STRING, category STRING")
    m = MF.hourly_manifest_between(spark, JAN, JAN + dt.timedelta(hours=47))
    r = IG.ingest(spark, base, m, V.SnapshotTable(spark, f"{workdir}/t"), f"{workdir}/l", kw)
    assert (r["succeeded"], r["failed"], r["rows_inserted"]) == (44, bad, 44)
    failed = L.read_ledger(spark, f"{workdir}/l").where("status = 'failed'").collect()
    assert len(failed) == bad and all(x.error_message for x in failed)
    assert max(reads.values()) <= 7 and sum(reads.values()) <= 48 * 3  # at most one read a halving


def test_a_new_epoch_makes_all_files_pending(spark, workdir):
    base = _dumps(workdir, 3, {1})
    kw = spark.createDataFrame([("DuckDB", "database")], "keyword STRING, category STRING")
    m = MF.hourly_manifest_between(spark, JAN, JAN + dt.timedelta(hours=2))
    for fact in (V.SnapshotTable(spark, f"{workdir}/t"), f"{workdir}/fact"):
        ledger = f"{workdir}/l-{isinstance(fact, str)}"
        assert IG.ingest(spark, base, m, fact, ledger, kw, run_id="a")["succeeded"] == 2
        PL.reset(spark, fact, ledger, now=dt.datetime(2020, 1, 1))  # a clock that lags
        rows = fact.read() if not isinstance(fact, str) else IG.read_fact(spark, fact)
        assert rows.count() == 0 and L.ledger_latest(L.read_ledger(spark, ledger)).count() == 0
        r = IG.ingest(spark, base, m, fact, ledger, kw, run_id="b")
        assert (r["attempted"], r["succeeded"]) == (3, 2)
        history = L.read_ledger(spark, ledger)
        assert [(x.run_id, x.attempted) for x in L.run_summary(history).collect()] == [("a", 3), ("b", 3)]
        assert L.latest_loads(history, 20).count() == 6 and L.status_rollup(history).count() == 2


def test_the_ledger_keeps_few_files(spark, workdir, monkeypatch):
    monkeypatch.setattr(L, "LEDGER_FILES", 6)
    path = f"{workdir}/l"
    for k in range(14):
        L.append_ledger(spark.createDataFrame([(f"f{k % 3}", k, dt.datetime(2025, 1, 1, k), "success", None, f"r{k}")], S.LEDGER), path)
        assert len([f for f in os.listdir(path) if f.startswith("part-")]) <= 6
    assert L.read_ledger(spark, path).count() == 14
    assert sorted((r.file_pattern, r.rows_inserted) for r in L.ledger_latest(L.read_ledger(spark, path)).collect()) == [("f0", 12), ("f1", 13), ("f2", 11)]
    os.rename(path, f"{path}._old")  # a crash in the middle of putting files together
    assert L.read_ledger(spark, path).count() == 14


def test_two_loaders_load_each_file_once(spark, workdir):
    base = _dumps(workdir, 4, set())
    kw = spark.createDataFrame([("DuckDB", "database")], "keyword STRING, category STRING")
    m = MF.hourly_manifest_between(spark, JAN, JAN + dt.timedelta(hours=3))
    done = []
    threads = [threading.Thread(target=lambda k=k: done.append(IG.ingest(spark, base, m, f"{workdir}/fact", f"{workdir}/l", kw, run_id=f"r{k}")))
               for k in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(r["attempted"] for r in done) == [0, 4] and L.read_ledger(spark, f"{workdir}/l").count() == 4


def test_a_lease_of_a_dead_holder_is_taken_over(spark, workdir):
    at = f"{workdir}/x.lease"
    dead = Lease(spark, at, seconds=1)
    assert dead._free()  # and never kept fresh
    with Lease(spark, at, seconds=1, wait=30) as mine:
        assert mine._mine() and not dead._mine()
        with pytest.raises(TimeoutError):
            Lease(spark, at, seconds=60, wait=0).__enter__()
    assert not os.path.exists(at)


def test_the_stream_tries_failed_files_again(spark, workdir):
    base = _dumps(workdir, 3, {1})
    kw = spark.createDataFrame([("DuckDB", "database")], "keyword STRING, category STRING")
    paths = f"{workdir}/fact", f"{workdir}/l"

    def run():
        run_stream_load(spark, base, *paths, kw, f"{workdir}/ck", retry_failed=True)
        return IG.read_fact(spark, paths[0]).count(), L.read_ledger(spark, paths[1]).count()

    assert run() == (2, 3)
    assert run() == (2, 4)  # once a run, still broken
    _dumps(workdir, 3, set())
    assert run() == (3, 5)
    assert run() == (3, 5)
    with pytest.raises(ValueError):
        start_stream_load(spark, base, *paths, kw, f"{workdir}/ck2", available_now=False, retry_failed=True)


def test_detected_types(spark):
    df = spark.createDataFrame([("1", "3000000000", "1.5", "2024-01-01 00:00:00", "true", "x", None), ("2", "4", "2", None, "false", "1", None)],
                               ", ".join(f"c{k} string" for k in range(7)))
    got = {r.column_name: r.data_type for r in detect_types(df).collect()}
    assert got == {"c0": "int", "c1": "bigint", "c2": "double", "c3": "timestamp", "c4": "boolean", "c5": "string", "c6": "string"}


def test_incremental_runs_over_versions(spark, workdir):
    base, lay = _dumps(workdir, 4, {2}), PL.Layout(f"{workdir}/tables")
    m = lambda n: MF.hourly_manifest_between(spark, JAN, JAN + dt.timedelta(hours=n - 1))
    plain = PL.run_incremental(spark, base, PL.Layout(f"{workdir}/plain"), m(4), run_id="a", db=None)
    r = PL.run_incremental(spark, base, lay, m(2), run_id="a", db=None, versioned=True)
    assert (r["succeeded"], r["total_rows"]) == (2, 2)
    r = PL.run_incremental(spark, base, lay, m(4), run_id="b", db=None, versioned=True)
    assert (r["attempted"], r["succeeded"], r["total_rows"]) == (2, 1, 3) and plain["total_rows"] == 3
    assert PL.run_incremental(spark, base, lay, m(2), run_id="c", db=None, versioned=True)["attempted"] == 0
    one, two = (V.current_frame(spark, x.summary, S.SUMMARY).drop("generated_at").first() for x in (lay, PL.Layout(f"{workdir}/plain")))
    assert one == two and one.total_rows == 3
    assert {x.table_name: x.row_count for x in PL.census(spark, lay).collect()}["pageviews"] == 3


def test_append_is_refused(spark, workdir):
    base = _dumps(workdir, 1, set())
    m = MF.hourly_manifest_between(spark, JAN, JAN)
    with pytest.raises(ValueError, match="append"):
        IG.ingest(spark, base, m, V.SnapshotTable(spark, f"{workdir}/t"), f"{workdir}/l", None, mode="append")
