"""Reports over the page-view fact.

All reports are partial/final hash aggregates (map-side combine), so a page
or category holding a third of all rows is reduced to one row per task
before the shuffle. Top-k uses ``orderBy(...).limit(k)``, which Catalyst
plans as ``TakeOrderedAndProject`` (per-partition top-k, then merge).
Ties are broken by the group key (D6) so results are deterministic.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow.session import checkpoint_root


def _month_bound(fact: DataFrame, lower_ts: Column) -> DataFrame:
    """Add a ``ym`` predicate beside a ``time`` predicate so month partitions prune."""
    if "ym" in fact.columns:
        return fact.where(F.col("ym") >= (F.year(lower_ts) * 100 + F.month(lower_ts)))
    return fact


def row_count(fact: DataFrame) -> DataFrame:
    """Number of rows."""
    return fact.agg(F.count(F.lit(1)).alias("total_rows"))


def page_totals(fact: DataFrame) -> DataFrame:
    """One row per page: ``path, total_hits, records, latest_time`` (the shared first aggregate)."""
    return fact.groupBy("path").agg(F.sum("hits").alias("total_hits"), F.count(F.lit(1)).alias("records"),
                                    F.max("time").alias("latest_time"))


def _top(per_page: DataFrame, k: int) -> DataFrame:
    return (per_page.select("path", "total_hits", "records")
            .orderBy(F.desc("total_hits"), F.asc("path"))
            .limit(k))


def _categories(per_page: DataFrame, keywords: DataFrame) -> DataFrame:
    kw = keywords.select("keyword", "category").distinct()
    j = per_page.join(kw, per_page["path"] == kw["keyword"])
    return (j.groupBy("category")
            .agg(F.count(F.lit(1)).alias("unique_pages"), F.sum("total_hits").alias("total_hits"))
            .orderBy(F.desc("total_hits"), F.asc("category")))


def top_pages(fact: DataFrame, k: int = 10) -> DataFrame:
    """R2: pages by total hits, with the number of records, top ``k``."""
    return (fact.groupBy("path")
            .agg(F.sum("hits").alias("total_hits"), F.count(F.lit(1)).alias("records"))
            .orderBy(F.desc("total_hits"), F.asc("path"))
            .limit(k))


def category_breakdown(fact: DataFrame, keywords: DataFrame) -> DataFrame:
    """R3 (J2): distinct pages and hits per keyword category.

    The fact is first reduced to one row per page; only that (small,
    keyword-bounded) relation meets the broadcast dimension. This is
    equal to joining first because the category is a function of the
    page, and it means the join and the distinct count never see raw rows.
    """
    return _categories(fact.groupBy("path").agg(F.sum("hits").alias("total_hits")), keywords)


def trailing_top_pages(fact: DataFrame, as_of: Column | _dt.date | None = None,
                       days: int = 7, k: int = 10) -> DataFrame:
    """R4 (P15): top pages with ``time >= as_of - days``; ``as_of`` defaults to today."""
    if as_of is None:
        as_of_c = F.current_date()
    elif isinstance(as_of, Column):
        as_of_c = as_of
    else:
        as_of_c = F.lit(as_of)
    lower = F.date_sub(as_of_c, days).cast("timestamp")
    f = _month_bound(fact, lower).where(F.col("time") >= lower)
    return (f.groupBy("path").agg(F.sum("hits").alias("total_views"))
            .orderBy(F.desc("total_views"), F.asc("path"))
            .limit(k))


def latest_date(fact: DataFrame) -> Column:
    """Scalar-subquery column: the date of the newest fact row."""
    return fact.agg(F.to_date(F.max("time"))).scalar()


def daily_trend(fact: DataFrame, page: str) -> DataFrame:
    """R5 (P16): daily hits for one page, by date (the equality reaches the Parquet scan)."""
    return (fact.where(F.col("path") == F.lit(page))
            .groupBy(F.to_date("time").alias("date"))
            .agg(F.sum("hits").alias("daily_views"))
            .orderBy("date"))


def table_health(fact: DataFrame) -> DataFrame:
    """Rows, time span and distinct pages."""
    return fact.agg(F.count(F.lit(1)).alias("total_rows"),
                    F.min("time").alias("earliest_date"),
                    F.max("time").alias("latest_date"),
                    F.countDistinct("path").alias("unique_pages"))


def coverage(fact: DataFrame) -> DataFrame:
    """Rows, distinct days, earliest and latest hour."""
    return fact.agg(F.count(F.lit(1)).alias("rows"),
                    F.countDistinct(F.to_date("time")).alias("days"),
                    F.min("time").alias("earliest"),
                    F.max("time").alias("latest"))


def summary_snapshot(fact: DataFrame, keywords: DataFrame, k: int = 10,
                     generated_at: Column | None = None, stamp_latest: bool = False) -> DataFrame:
    """One row ``total_rows, top_pages[], category_breakdown[], generated_at`` of the whole fact."""
    return summary_of(page_totals(fact), keywords, k, generated_at, stamp_latest)


def summary_of(per_page: DataFrame, keywords: DataFrame, k: int = 10,
               generated_at: Column | None = None, stamp_latest: bool = False) -> DataFrame:
    """R10 from page totals, wherever they come from.

    All three parts come from one per-page aggregate (``page_totals``),
    materialised once with a reliable ``checkpoint()`` in the shared
    checkpoint folder, so the fact is read and aggregated a single time and
    the three small parts read the checkpoint. The arrays are bounded (``k`` pages; one entry per category
    of the dimension), so collecting them into one row is safe; they are
    sorted with the same keys as the flat reports. ``stamp_latest`` stamps
    the snapshot with the newest fact time instead of the clock.
    """
    checkpoint_root(per_page.sparkSession)
    per_page = per_page.checkpoint(eager=True)
    tp = (_top(per_page, k)
          .agg(F.array_sort(F.collect_list(F.struct(
              (-F.col("total_hits")).alias("o1"), F.col("path").alias("o2"),
              F.col("path").alias("path"), F.col("total_hits").alias("hits"),
              F.col("records").alias("records")))).alias("a"))
          .select(F.transform("a", lambda s: F.struct(s["path"].alias("path"), s["hits"].alias("hits"),
                                                      s["records"].alias("records"))).alias("top_pages")))
    cb = (_categories(per_page, keywords)
          .agg(F.array_sort(F.collect_list(F.struct(
              (-F.col("total_hits")).alias("o1"), F.col("category").alias("o2"),
              F.col("category").alias("category"), F.col("unique_pages").alias("unique_pages"),
              F.col("total_hits").alias("hits")))).alias("a"))
          .select(F.transform("a", lambda s: F.struct(s["category"].alias("category"),
                                                      s["unique_pages"].alias("unique_pages"),
                                                      s["hits"].alias("hits"))).alias("category_breakdown")))
    total = per_page.agg(F.coalesce(F.sum("records"), F.lit(0)).cast("long").alias("total_rows"),
                         F.max("latest_time").alias("_latest"))
    if generated_at is not None:
        gen = generated_at
    elif stamp_latest:
        gen = F.col("_latest")
    else:
        gen = F.current_timestamp()
    return (total.select(F.col("total_rows"),
                         tp.select("top_pages").scalar().alias("top_pages"),
                         cb.select("category_breakdown").scalar().alias("category_breakdown"),
                         gen.alias("generated_at")))


def table_census(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` for each table, unioned."""
    out = None
    for name, df in tables.items():
        c = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = c if out is None else out.unionByName(c)
    return out
