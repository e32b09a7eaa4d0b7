"""Ad hoc exploration of raw dumps.

Filters are plain column predicates on the CSV scan, so Catalyst pushes them
into the scan (``PushedFilters: [In(page_title, …)]``, ``StringContains``)
and prunes unread columns (``ReadSchema``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VIEW_COLS = ["page_title", "view_count", "bytes_served"]


def title_in_list(rows: DataFrame, titles: Iterable[str], limit: int | None = None) -> DataFrame:
    """Rows whose title is one of ``titles`` (case-sensitive)."""
    out = rows.where(F.col("page_title").isin(list(titles))).select(*VIEW_COLS)
    return out.limit(limit) if limit else out


def title_like_mix(rows: DataFrame, likes: Sequence[str], titles: Iterable[str] = (),
                   limit: int | None = None) -> DataFrame:
    """``title LIKE p1 OR LIKE p2 … OR title IN (…)``, case-sensitive."""
    cond = None
    for p in likes:
        c = F.col("page_title").like(p)
        cond = c if cond is None else cond | c
    titles = list(titles)
    if titles:
        c = F.col("page_title").isin(titles)
        cond = c if cond is None else cond | c
    out = rows.where(cond).select(*VIEW_COLS)
    return out.limit(limit) if limit else out


def known_projects(rows: DataFrame) -> DataFrame:
    """The four columns of rows with a project."""
    return rows.where(F.col("project").isNotNull()).select("project", *VIEW_COLS)


def raw_preview(rows: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows in a deterministic order (all columns ascending, D7)."""
    return rows.orderBy(*[F.asc_nulls_first(c) for c in rows.columns]).limit(n)
