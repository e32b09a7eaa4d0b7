"""Dimension seeding, dedup contract, manifests and plan shapes."""

import datetime as dt

from pyspark.sql import functions as F

from pageflow.operators import dims as D
from pageflow.operators import maintain as M
from pageflow.operators import reports as R
from pageflow.sources import manifest as MF


def test_keyword_seed_twice_is_29(spark, workdir):
    p = f"{workdir}/kw"
    assert D.seed_keywords(spark, p) == 29
    assert D.seed_keywords(spark, p) == 0
    assert spark.read.parquet(p).count() == 29
    assert D.add_keyword(spark, p, "Polars", "library") == 1
    assert D.add_keyword(spark, p, "Polars", "library") == 0


def _two_rows_twice(spark):
    rows = [(dt.datetime(2025, 1, 1, 1), "en", "", "A", 3), (dt.datetime(2025, 1, 1, 1), "en", "m", "A", 4)]
    df = spark.createDataFrame(rows, "time TIMESTAMP, project STRING, subproject STRING, path STRING, hits BIGINT")
    return (df.withColumn("ingestion_date", F.lit("2025-01-02").cast("date"))
            .unionByName(df.withColumn("ingestion_date", F.lit("2025-01-03").cast("date"))))


def test_dedup_contract(spark):
    twice = _two_rows_twice(spark)
    hits = lambda df: df.agg(F.sum("hits")).first()[0]
    assert hits(M.drop_exact_duplicates(twice.drop("ingestion_date"))) == 7
    assert hits(M.keep_latest(twice)) == 7
    assert hits(M.collapse_sum(twice)) == 14
    assert M.keep_latest(twice, ["path", "time"]).count() == 1
    assert hits(M.dedup_loads(twice)) == 7


def test_dedup_loads_keeps_in_file_collisions(spark):
    t = dt.datetime(2025, 1, 1, 1)
    rows = [(t, "en", "", "hot_gear", 2), (t, "en", "", "hot_gear", 5)]  # two raw spellings, one key
    df = spark.createDataFrame(rows, "time TIMESTAMP, project STRING, subproject STRING, path STRING, hits BIGINT")
    twice = (df.withColumn("ingestion_date", F.lit("2025-01-02").cast("date"))
             .unionByName(df.withColumn("ingestion_date", F.lit("2025-01-03").cast("date"))))
    assert M.dedup_loads(twice).first().hits == 7
    assert M.keep_latest(twice).first().hits == 5


def test_calendar_manifest(spark):
    m = MF.calendar_manifest(spark, 2025, 1, range(1, 4), range(0, 2)).collect()
    assert [r.file_pattern for r in m][:3] == [
        "2025/2025-01/pageviews-20250101-000000.gz",
        "2025/2025-01/pageviews-20250101-010000.gz",
        "2025/2025-01/pageviews-20250102-000000.gz"]
    assert len(m) == 6


def test_listing_and_location(spark):
    txt = spark.createDataFrame([('<a href="pageviews-20251001-000000.gz">x</a> pageviews-20251001-000000.gz',),
                                 ("pageviews-20150501-230000.gz junk",)], "value STRING")
    names = MF.listing_manifest(txt)
    got = names.select("file_name", MF.full_location("file_name", "https://h/p/").alias("u")).collect()
    assert [(r.file_name, r.u) for r in got] == [
        ("pageviews-20150501-230000.gz", "https://h/p/2015/2015-05/pageviews-20150501-230000.gz"),
        ("pageviews-20251001-000000.gz", "https://h/p/2025/2025-10/pageviews-20251001-000000.gz")]


def test_seed_keeps_every_category(spark, workdir):
    from pageflow.operators import dims as D
    seed = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "x")], "keyword STRING, category STRING")
    assert D.seed_keywords(spark, f"{workdir}/kw", seed) == 2 and D.seed_keywords(spark, f"{workdir}/kw", seed) == 0
    assert {(r.keyword, r.category) for r in spark.read.parquet(f"{workdir}/kw").collect()} == {("a", "x"), ("a", "y")}


def test_lines_reach_every_part(spark):
    """The derived lines and keywords use the whole part table at every size."""
    from pageflow.plans import fixtures as X
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        names = {r[0].replace(" ", "_") for r in X.table(spark, sf, "part").select("p_name").distinct().collect()}
        kw = {r.keyword for r in X.keyword_seed(spark, sf).collect()}
        assert kw == {n for n in names if any(x in n for x in ("widget", "gear", "rod"))}
        assert X.part_keys(spark, sf) == X.table(spark, sf, "part").count()


def test_no_text_meets_in_the_top_articles_task(spark):
    from pageflow.operators import articles as A
    df = spark.createDataFrame([(str(i), "t", "etl " * i, "u") for i in range(5)], "id STRING, title STRING, text STRING, url STRING")
    top = A.top_articles(df, n=2)
    assert [r.article_length for r in top.collect()] == [16, 12]
    plan = top._jdf.queryExecution().executedPlan().toString()
    first = [x for x in plan.splitlines() if "TakeOrderedAndProject" in x][-1]
    assert "text" not in first


def test_reports_on_tiny_fact(spark):
    t = dt.datetime(2025, 1, 5, 3)
    rows = [(t, "en", "", "A", 3), (t, "en", "", "B", 3), (t - dt.timedelta(days=10), "en", "", "C", 100)]
    f = spark.createDataFrame(rows, "time TIMESTAMP, project STRING, subproject STRING, path STRING, hits BIGINT")
    top = R.top_pages(f).collect()
    assert [r.path for r in top] == ["C", "A", "B"]  # tie A/B broken by path
    wk = R.trailing_top_pages(f, as_of=dt.date(2025, 1, 5)).collect()
    assert [r.path for r in wk] == ["A", "B"]
    kw = spark.createDataFrame([("A", "x"), ("B", "x"), ("C", "y")], "keyword STRING, category STRING")
    cb = {r.category: (r.unique_pages, r.total_hits) for r in R.category_breakdown(f, kw).collect()}
    assert cb == {"x": (2, 6), "y": (1, 100)}
    snap = R.summary_snapshot(f, kw).first()
    assert snap.total_rows == 3 and snap.top_pages[0].path == "C" and snap.category_breakdown[0].category == "y"


def test_hot_key_reports_and_dedup(spark):
    # one page holds a third of all rows; every operator must stay exact
    t = dt.datetime(2025, 1, 1, 1)
    rows = [(t + dt.timedelta(hours=i % 5), "en", "", "HOT" if i % 3 == 0 else f"p{i % 11}", 1) for i in range(3000)]
    f = spark.createDataFrame(rows, "time TIMESTAMP, project STRING, subproject STRING, path STRING, hits BIGINT")
    top = R.top_pages(f, 1).first()
    assert (top.path, top.total_hits, top.records) == ("HOT", 1000, 1000)
    twice = (f.withColumn("ingestion_date", F.lit("2025-01-02").cast("date"))
             .unionByName(f.withColumn("ingestion_date", F.lit("2025-01-03").cast("date"))))
    d = M.dedup_loads(twice)
    assert d.agg(F.sum("hits")).first()[0] == 3000
    assert d.where(F.col("path") == "HOT").agg(F.sum("hits")).first()[0] == 1000
    plan = M.dedup_loads(twice)._jdf.queryExecution().executedPlan().toString()
    assert "partial_" in plan  # map-side combine before the shuffle


def test_default_job_is_six_files(spark):
    from pageflow.config import JobConfig
    m = JobConfig(base="/nowhere").manifest(spark).collect()
    assert len(m) == 6 and m[0].file_pattern == "2025/2025-01/pageviews-20250101-000000.gz"
    assert m[-1].file_pattern == "2025/2025-01/pageviews-20250103-010000.gz"


def test_keep_latest_hash_path_equals_struct_path(spark):
    import random
    rnd = random.Random(7)
    t = dt.datetime(2025, 1, 1)
    rows = [(t + dt.timedelta(hours=rnd.randint(0, 3)), "en", rnd.choice(["", "m"]), rnd.choice("ABCD"),
             rnd.randint(0, 5), dt.date(2025, 2, rnd.randint(1, 3))) for _ in range(400)]
    f = spark.createDataFrame(rows, "time TIMESTAMP, project STRING, subproject STRING, path STRING, hits BIGINT, "
                                    "ingestion_date DATE")
    fast = M.keep_latest(f)
    slow = (f.groupBy("time", "project", "subproject", "path")
            .agg(F.max(F.struct("ingestion_date", "hits")).alias("b"))
            .select("time", "project", "subproject", "path", "b.ingestion_date", "b.hits"))
    key = lambda df: sorted(tuple(r) for r in df.select("time", "project", "subproject", "path",
                                                         "ingestion_date", "hits").collect())
    assert key(fast) == key(slow)
    assert "SortAggregate" not in fast._jdf.queryExecution().executedPlan().toString()
