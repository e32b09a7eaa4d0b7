"""Plan shapes: pushdown, broadcast joins, top-k, partial aggregation."""

import __spark_entry__ as E
from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_pages_plan(spark):
    p = _plan(E.queries()["top_pages"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p
    assert "SortMergeJoin" not in p


def test_title_filter_pushed_to_scan(spark):
    df = E.queries()["title_in_list"](spark, SF_SMALL)
    p = _plan(df)
    assert "PushedFilters: [In(page_title" in p or "PushedFilters: [*In(page_title" in p, p


def test_category_preaggregates_before_join(spark):
    p = _plan(E.queries()["category_breakdown"](spark, SF_SMALL))
    assert "SortMergeJoin" not in p
    assert p.count("HashAggregate") >= 4


def test_keep_latest_is_aggregate_not_window(spark):
    p = _plan(E.queries()["keep_latest"](spark, SF_SMALL))
    assert "Window" not in p and "HashAggregate" in p or "ObjectHashAggregate" in p or "SortAggregate" in p


CHEAP = ["top_pages", "category_breakdown", "row_count", "daily_trend", "table_health", "coverage",
         "trailing_week_top", "collapse_sum", "keep_latest", "drop_duplicates", "dedup_loads", "parse_lenient",
         "parse_strict", "timestamp_from_filename", "file_quarantine", "keyword_seed", "file_manifest",
         "listing_manifest", "ledger_latest", "ledger_status", "latest_loads", "run_summary", "pending_files",
         "table_census", "summary_snapshot", "topic_flag", "mention_counts", "first_paragraph", "top_articles",
         "load_stats"]


def test_no_python_udfs_or_pairwise_joins(spark):
    qs = E.queries()
    for k in CHEAP:
        p = _plan(qs[k](spark, SF_SMALL))
        for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
                    "BroadcastNestedLoopJoin"):
            assert bad not in p, (k, bad)
