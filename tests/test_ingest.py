"""Ingest contract: idempotency, isolation, replay, stream = batch."""

import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F

from pageflow.operators import ledger as L
from pageflow.plans import ingest as IG
from pageflow.sources import manifest as MF
from pageflow.streaming.filestream import run_stream_load

KW = [("DuckDB", "database"), ("Apache_Spark", "processing_engine"), ("Data_lake", "concept")]


def _write(base, name, lines, raw=None):
    d = os.path.join(base, name[10:14], f"{name[10:14]}-{name[14:16]}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "wb") as f:
        f.write(raw if raw is not None else gzip.compress(("\n".join(lines) + "\n").encode()))


def _kw(spark):
    return spark.createDataFrame(KW, "keyword STRING, category STRING")


def _manifest(spark, hours):
    return MF.hourly_manifest_between(spark, dt.datetime(2025, 1, 1, 0), dt.datetime(2025, 1, 1, hours - 1))


GOOD = {
    "pageviews-20250101-000000.gz": ["en DuckDB 12 0", "en.m DuckDB 7 0", "de DuckDB 9 0", "en Other 5 0"],
    "pageviews-20250101-010000.gz": ["en Apache_Spark 4 0", "en Data_lake notnum 0", "en Other x 0"],
    "pageviews-20250101-020000.gz": ["en Data_lake 3 0", "en hot%5Fgear 1 0"],
}


def _setup(workdir, names=GOOD):
    base = os.path.join(workdir, "dumps")
    for n, ls in names.items():
        _write(base, n, ls)
    return base


def test_incremental_skip_quarantine_and_retry(spark, workdir):
    base = _setup(workdir)
    fact, ledger = f"{workdir}/fact", f"{workdir}/ledger"
    r1 = IG.ingest(spark, base, _manifest(spark, 3), fact, ledger, _kw(spark), run_id="r1")
    # hour 01 has a kept row with an unusable count -> failed, others loaded
    assert (r1["attempted"], r1["succeeded"], r1["failed"], r1["rows_inserted"]) == (3, 2, 1, 3)
    f = spark.read.parquet(fact)
    assert sorted((r.path, r.hits) for r in f.collect()) == [("Data_lake", 3), ("DuckDB", 7), ("DuckDB", 12)]
    st = {r.file_pattern: r.status for r in L.ledger_latest(L.read_ledger(spark, ledger)).collect()}
    assert st["2025/2025-01/pageviews-20250101-010000.gz"] == "failed"
    # second run: only the failed file is retried, still failing, nothing duplicated
    r2 = IG.ingest(spark, base, _manifest(spark, 3), fact, ledger, _kw(spark), run_id="r2")
    assert (r2["attempted"], r2["failed"]) == (1, 1)
    assert spark.read.parquet(fact).count() == 3
    # fix the file, third run loads it only
    _write(base, "pageviews-20250101-010000.gz", ["en Apache_Spark 4 0", "en Data_lake 2 0"])
    r3 = IG.ingest(spark, base, _manifest(spark, 3), fact, ledger, _kw(spark), run_id="r3")
    assert (r3["attempted"], r3["succeeded"], r3["rows_inserted"]) == (1, 1, 2)
    assert spark.read.parquet(fact).agg(F.sum("hits")).first()[0] == 12 + 7 + 3 + 4 + 2
    r4 = IG.ingest(spark, base, _manifest(spark, 3), fact, ledger, _kw(spark), run_id="r4")
    assert r4["attempted"] == 0
    roll = {r.status: (r.files, r.total_rows) for r in L.status_rollup(L.read_ledger(spark, ledger)).collect()}
    assert roll == {"success": (3, 5)}


def test_missing_and_corrupt_files_fail_alone(spark, workdir):
    base = _setup(workdir)
    _write(base, "pageviews-20250101-030000.gz", [], raw=b"this is not gzip")
    fact, ledger = f"{workdir}/fact", f"{workdir}/ledger"
    # 5 hours: 00-02 good/quarantined, 03 corrupt, 04 missing
    r = IG.ingest(spark, base, _manifest(spark, 5), fact, ledger, _kw(spark), run_id="r1")
    assert (r["attempted"], r["succeeded"], r["failed"]) == (5, 2, 3)
    rows = {x.file_pattern.rsplit("/", 1)[-1]: x for x in L.read_ledger(spark, ledger).collect()}
    assert rows["pageviews-20250101-040000.gz"].error_message == "file not found"
    assert rows["pageviews-20250101-030000.gz"].status == "failed"
    assert spark.read.parquet(fact).count() == 3


def test_replay_after_crash_is_idempotent(spark, workdir):
    base = _setup(workdir)
    fact, ledger = f"{workdir}/fact", f"{workdir}/ledger"
    IG.ingest(spark, base, _manifest(spark, 3), fact, ledger, _kw(spark), run_id="r1")
    before = sorted(tuple(r) for r in spark.read.parquet(fact).select("time", "path", "hits").collect())
    # crash between data write and ledger append: lose the ledger, replay everything
    IG.ingest(spark, base, _manifest(spark, 3), fact, f"{workdir}/ledger-lost", _kw(spark), run_id="r2")
    after = sorted(tuple(r) for r in spark.read.parquet(fact).select("time", "path", "hits").collect())
    assert before == after


def test_basic_append_duplicates(spark, workdir):
    base = _setup(workdir)
    fact = f"{workdir}/fact"
    for i in range(2):
        IG.ingest(spark, base, _manifest(spark, 3), fact, f"{workdir}/l{i}", _kw(spark), mode="append")
    assert spark.read.parquet(fact).count() == 6


def test_stream_equals_batch_and_only_new_files(spark, workdir):
    base = _setup(workdir)
    sfact, sled, ck = f"{workdir}/sfact", f"{workdir}/sled", f"{workdir}/ck"
    run_stream_load(spark, base, sfact, sled, _kw(spark), ck)
    bfact = f"{workdir}/bfact"
    IG.ingest(spark, base, _manifest(spark, 3), bfact, f"{workdir}/bled", _kw(spark))
    key = lambda df: sorted(tuple(r) for r in df.select("time", "project", "subproject", "path", "hits").collect())
    assert key(spark.read.parquet(sfact)) == key(spark.read.parquet(bfact))
    n1 = L.read_ledger(spark, sled).count()
    run_stream_load(spark, base, sfact, sled, _kw(spark), ck)  # nothing new
    assert L.read_ledger(spark, sled).count() == n1
    _write(base, "pageviews-20250101-050000.gz", ["en DuckDB 1 0"])
    run_stream_load(spark, base, sfact, sled, _kw(spark), ck)
    new = L.read_ledger(spark, sled).where(F.col("file_pattern").contains("050000")).collect()
    assert len(new) == 1 and new[0].rows_inserted == 1
    assert spark.read.parquet(sfact).count() == 4


def test_strict_parser_load(spark, workdir):
    base = _setup(workdir)
    r = IG.ingest(spark, base, _manifest(spark, 3), f"{workdir}/fact", f"{workdir}/l", None,
                  projects=None, parser="strict")
    f = spark.read.parquet(f"{workdir}/fact")
    # strict: no keyword/project filter; 2-token-count and non-numeric lines rejected
    assert r["failed"] == 0
    assert ("m", ".m") not in {(x.subproject, x.subproject) for x in f.collect()}
    assert sorted(x.subproject for x in f.where(F.col("path") == "DuckDB").collect()) == ["", "", ".m"]


def test_fact_files_are_sorted(spark, workdir):
    import pyarrow.parquet as pq
    rows = [(dt.datetime(2025, 1, 1, i % 3), "en", "", f"P{(i * 37) % 101:03d}", i, f"pageviews-20250101-0{i % 3}0000.gz")
            for i in range(600)]
    df = spark.createDataFrame(rows, "time TIMESTAMP, project STRING, subproject STRING, path STRING, hits BIGINT, "
                                     "file_name STRING").repartition(4)
    IG.write_fact(df, f"{workdir}/fact")
    files = [os.path.join(d, f) for d, _, names in os.walk(f"{workdir}/fact") for f in names if f.endswith(".parquet")]
    assert len(files) >= 3
    for f in files:
        paths = pq.ParquetFile(f).read(columns=["path"]).column("path").to_pylist()
        assert paths == sorted(paths)
    assert IG.read_fact(spark, f"{workdir}/fact").count() == 600


def test_replay_is_safe_in_a_session_without_settings(spark, workdir):
    base = _setup(workdir)
    bare = spark.newSession()
    for k in spark.sparkContext.getConf().getAll():
        if k[0] == "spark.sql.sources.partitionOverwriteMode":
            bare.conf.set(k[0], "static")
    first = MF.hourly_manifest_between(bare, dt.datetime(2025, 1, 1, 0), dt.datetime(2025, 1, 1, 0))
    IG.ingest(bare, base, first, f"{workdir}/fact", f"{workdir}/l", _kw(bare))
    IG.ingest(bare, base, _manifest(bare, 3), f"{workdir}/fact", f"{workdir}/l", _kw(bare))
    assert IG.read_fact(bare, f"{workdir}/fact").count() == 3


def test_two_files_of_one_hour_and_a_replay_that_keeps_nothing(spark, workdir):
    base = _setup(workdir, {"pageviews-20250101-000000.gz": ["en DuckDB 1 0"], "pageviews-20250101-003000.gz": ["en DuckDB 2 0"]})
    fact = f"{workdir}/fact"
    for k, name in enumerate(["000000", "003000"]):
        m = spark.createDataFrame([(f"2025/2025-01/pageviews-20250101-{name}.gz",)], "file_pattern STRING")
        IG.ingest(spark, base, m, fact, f"{workdir}/l{k}", _kw(spark))
    assert sorted(r.hits for r in IG.read_fact(spark, fact).collect()) == [1, 2]
    _write(base, "pageviews-20250101-003000.gz", ["en Other 5 0"])
    r = IG.ingest(spark, base, m, fact, f"{workdir}/l2", _kw(spark))
    assert (r["succeeded"], r["rows_inserted"]) == (1, 0)
    assert [r.hits for r in IG.read_fact(spark, fact).collect()] == [1]


def test_other_failures_are_not_blamed_on_files(spark, workdir, monkeypatch):
    base = _setup(workdir)
    def full(*_):
        raise OSError("no space left on device")
    monkeypatch.setattr(IG, "_stage", full)
    with pytest.raises(OSError, match="no space"):
        IG.ingest(spark, base, _manifest(spark, 3), f"{workdir}/fact", f"{workdir}/l", _kw(spark))
    assert L.read_ledger(spark, f"{workdir}/l").count() == 0


def test_unreadable_tables_are_not_empty(spark, workdir):
    with pytest.raises(Exception, match="nosuchfs"):
        L.read_ledger(spark, "nosuchfs://x/ledger").count()
    os.makedirs(f"{workdir}/fact/ym=202501/src_file=a")
    with open(f"{workdir}/fact/ym=202501/src_file=a/part-0.parquet", "wb") as f:
        f.write(b"not parquet")
    with pytest.raises(Exception):
        IG.read_fact(spark, f"{workdir}/fact").collect()
    assert IG.read_fact(spark, f"{workdir}/nothing").count() == 0


def test_empty_run_keeps_the_summary(spark, workdir):
    from pageflow.plans import pipeline as PL
    base = _setup(workdir)
    lay = PL.Layout(f"{workdir}/tables")
    PL.run_incremental(spark, base, lay, _manifest(spark, 1), run_id="a", db=None)
    stamp = os.stat(f"{lay.summary}/_SUCCESS").st_mtime_ns
    r = PL.run_incremental(spark, base, lay, _manifest(spark, 1), run_id="b", db=None)
    assert r["attempted"] == 0 and os.stat(f"{lay.summary}/_SUCCESS").st_mtime_ns == stamp
    PL.truncate_fact(spark, lay, db=None)
    PL.write_summary(spark, lay, _kw(spark))
    assert spark.read.parquet(lay.summary).first().total_rows == 2


def test_stream_with_a_corrupt_file(spark, workdir):
    base = _setup(workdir)
    _write(base, "pageviews-20250101-030000.gz", [], raw=b"this is not gzip")
    for _ in range(2):  # the restart finds nothing to do
        run_stream_load(spark, base, f"{workdir}/f", f"{workdir}/l", _kw(spark), f"{workdir}/ck")
        led = {r.file_pattern.rsplit("/", 1)[-1]: r for r in L.read_ledger(spark, f"{workdir}/l").collect()}
        assert len(led) == 4 and L.read_ledger(spark, f"{workdir}/l").count() == 4
        assert led["pageviews-20250101-030000.gz"].status == "failed"
        assert "pageviews-20250101-030000.gz" in led["pageviews-20250101-030000.gz"].error_message
        assert IG.read_fact(spark, f"{workdir}/f").count() == 3


def test_rebuilt_table_takes_further_loads(spark, workdir):
    from pageflow.operators import maintain as M
    from pageflow.plans import pipeline as PL
    base = _setup(workdir)
    lay = PL.Layout(f"{workdir}/tables")
    PL.create_tables(spark, lay, db="pf_swap")
    for k in range(2):
        IG.ingest(spark, base, _manifest(spark, 1), lay.fact, f"{workdir}/l{k}", _kw(spark), mode="append")
    out = M.rebuild_and_swap(spark, lay.fact, f"{workdir}/rebuilt", M.collapse_sum, table="pf_swap.pageviews")
    assert sorted(r.hits for r in spark.sql("SELECT hits FROM pf_swap.pageviews").collect()) == [14, 24]
    IG.ingest(spark, base, _manifest(spark, 3), out, f"{workdir}/l9", _kw(spark))
    assert sorted(r.hits for r in IG.read_fact(spark, out).collect()) == [3, 7, 12]  # hour 0 is replaced, hour 2 added


def test_pipeline_tables_backfill_and_truncate(spark, workdir):
    from pageflow.plans import pipeline as PL
    base = _setup(workdir)
    lay = PL.Layout(f"{workdir}/tables")
    PL.create_tables(spark, lay, db="pf_test")
    PL.create_tables(spark, lay, db="pf_test")  # idempotent
    # the run seeds the reference keywords; this fixture names three of them
    m2 = MF.hourly_manifest_between(spark, dt.datetime(2025, 1, 1, 0), dt.datetime(2025, 1, 1, 1))
    r1 = PL.run_incremental(spark, base, lay, m2, run_id="a", db="pf_test")
    assert (r1["attempted"], r1["failed"]) == (2, 1)
    # backfill: widen the calendar, only the new hour is loaded
    r2 = PL.run_incremental(spark, base, lay, _manifest(spark, 3), run_id="b", db="pf_test")
    assert (r2["attempted"], r2["succeeded"]) == (2, 1)
    assert r2["total_rows"] == 3
    stats = spark.read.parquet(lay.load_stats)
    assert stats.count() == 4 and set(stats.columns) == {"date_pattern", "rows_inserted", "load_timestamp",
                                                          "status", "error_message"}
    snap = spark.read.parquet(lay.summary).first()
    assert snap.total_rows == 3 and snap.top_pages[0].path == "DuckDB"
    assert spark.sql("SELECT count(*) FROM pf_test.keywords").first()[0] == 29
    cen = {r.table_name: r.row_count for r in PL.census(spark, lay).collect()}
    assert cen == {"pageviews": 3, "keywords": 29, "processed_files": 4, "pageview_load_stats": 4,
                   "summary_statistics": 1}
    assert spark.sql("SELECT count(*) FROM pf_test.pageviews").first()[0] == 3
    PL.truncate_fact(spark, lay, db="pf_test")
    assert IG.read_fact(spark, lay.fact).count() == 0


def test_month_predicate_prunes_partitions(spark, workdir):
    from pageflow.operators import reports as R
    base = _setup(workdir)
    IG.ingest(spark, base, _manifest(spark, 3), f"{workdir}/fact", f"{workdir}/l", _kw(spark))
    f = spark.read.parquet(f"{workdir}/fact")
    df = R.trailing_top_pages(f, as_of=dt.date(2025, 1, 2))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ym" in plan and "(ym#" in plan, plan
    assert [r.path for r in df.collect()] == ["DuckDB", "Data_lake"]
    tp = R.daily_trend(f, "DuckDB")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(path,DuckDB)" in tp and "ReadSchema: struct<time:timestamp,path:string,hits:bigint>" in tp, tp


def test_stream_in_bounded_batches(spark, workdir):
    base = _setup(workdir)
    fact, led = f"{workdir}/f", f"{workdir}/l"
    run_stream_load(spark, base, fact, led, _kw(spark), f"{workdir}/ck", max_files_per_trigger=1)
    runs = {r.run_id for r in L.read_ledger(spark, led).collect()}
    assert len(runs) == 3  # one micro-batch per file
    assert spark.read.parquet(fact).count() == 3


def test_stream_records_files_without_kept_rows(spark, workdir):
    names = dict(GOOD)
    names["pageviews-20250101-030000.gz"] = ["de Other 1 0", "en Unrelated 2 0"]
    base = _setup(workdir, names)
    run_stream_load(spark, base, f"{workdir}/f", f"{workdir}/l", _kw(spark), f"{workdir}/ck")
    led = {r.file_pattern.rsplit("/", 1)[-1]: r for r in L.read_ledger(spark, f"{workdir}/l").collect()}
    assert led["pageviews-20250101-030000.gz"].status == "success"
    assert led["pageviews-20250101-030000.gz"].rows_inserted == 0
    assert led["pageviews-20250101-010000.gz"].status == "failed"


def test_compact_month(spark, workdir):
    from pageflow.operators import maintain as M
    base = _setup(workdir)
    IG.ingest(spark, base, _manifest(spark, 3), f"{workdir}/fact", f"{workdir}/l", _kw(spark))
    out = M.compact_months(spark, f"{workdir}/fact", f"{workdir}/compact", [202501])
    a = spark.read.parquet(f"{workdir}/fact").drop("src_file")
    b = spark.read.parquet(out)
    key = lambda df: sorted(tuple(r) for r in df.select("time", "path", "hits", "ym").collect())
    assert key(a) == key(b)
    assert len([f for f in os.listdir(f"{out}/ym=202501") if f.endswith(".parquet")]) == 1
