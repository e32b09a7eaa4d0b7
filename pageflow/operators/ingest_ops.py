"""Row-level ingest operators: lenient/strict parse, keyword filter, bad-row flags.

These are narrow transformations (no shuffle) except the keyword filter,
which is a left-semi join against a dimension that Spark broadcasts while it is small, so the
dump side is never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow.functions import parse as P


def parse_lenient(lines: DataFrame, line_col: str = "value", time_col: Column | None = None,
                  passthrough: Iterable[str] = ()) -> DataFrame:
    """Lenient parse (P1-P8): tokenise, split project, decode title, try-cast hits.

    Keeps lines with >= 3 tokens and a known title. ``hits`` is NULL for a
    non-numeric count; such rows are kept so the caller can quarantine the file.
    ``time_col`` defaults to the hour parsed from ``file_name``.
    """
    if time_col is None:
        time_col = P.time_from_file_name(F.col("file_name"))
    cols = P.lenient_columns(line_col)
    return (lines.where(P.lenient_keep(line_col))
            .select(*passthrough, time_col.alias("time"),
                    *[c.alias(n) for n, c in cols.items()]))


def parse_strict(lines: DataFrame, line_col: str = "value", time_col: Column | None = None,
                 passthrough: Iterable[str] = ()) -> DataFrame:
    """Strict parse (P10): only lines matching the 5-group grammar; title kept encoded."""
    if time_col is None:
        time_col = P.time_from_path_rewrite(F.col("file_path"))
    cols = P.strict_columns(line_col)
    return (lines.where(P.strict_match(line_col))
            .select(*passthrough, time_col.alias("time"),
                    *[c.alias(n) for n, c in cols.items()]))


def keep_keywords(parsed: DataFrame, keywords: DataFrame,
                  projects: Iterable[str] | None = P.DEFAULT_PROJECTS) -> DataFrame:
    """Rows whose decoded title is a keyword (J1) and whose project is listed.

    A left-semi join never multiplies rows, even if the dimension holds a
    keyword twice (B1). Spark broadcasts the dimension while it is small.
    """
    df = parsed
    if projects is not None:
        df = df.where(F.col("project").isin(list(projects)))
    kw = keywords.select(F.col("keyword")).where(F.col("keyword").isNotNull())
    return df.join(kw, df["path"] == kw["keyword"], "left_semi")


def with_bad_flag(parsed: DataFrame) -> DataFrame:
    """Add ``bad``: the count would fail the unsigned cast (NULL or negative)."""
    return parsed.withColumn("bad", P.is_bad_hits(F.col("hits")))


def flag_lenient(lines: DataFrame, keywords: DataFrame | None, line_col: str = "value",
                 time_col: Column | None = None, projects: Iterable[str] | None = P.DEFAULT_PROJECTS,
                 passthrough: Iterable[str] = ("file_name",), drop_unknown_title: bool = True) -> DataFrame:
    """Lenient parse of every line plus flags ``kept`` (would be loaded) and ``bad``.

    ``bad`` is evaluated only on kept rows, as the reference casts after its
    keyword and project filters (D3): garbage on unrelated pages does not fail
    a file. A left join on the (de-duplicated) keyword set
    gives the keyword flag without dropping lines. ``keywords=None``,
    ``projects=None`` and ``drop_unknown_title=False`` give the unfiltered
    full-history load (W3), which keeps every line with >= 3 tokens.
    """
    if time_col is None:
        time_col = P.time_from_file_name(F.col("file_name"))
    cols = P.lenient_columns(line_col)
    well_formed = P.lenient_keep(line_col) if drop_unknown_title else P.has_tokens(line_col, 3)
    parsed = lines.select(*passthrough, time_col.alias("time"), well_formed.alias("well_formed"),
                          *[c.alias(n) for n, c in cols.items()])
    in_projects = F.col("project").isin(list(projects)) if projects is not None else F.lit(True)
    if keywords is None:
        j, in_keywords = parsed, F.lit(True)
    else:
        kw = keywords.select(F.col("keyword").alias("_kw")).where(F.col("_kw").isNotNull()).distinct()
        j, in_keywords = parsed.join(kw, parsed["path"] == kw["_kw"], "left"), \
            F.col("_kw").isNotNull()
    kept = F.col("well_formed") & in_projects & in_keywords
    out = (j.withColumn("kept", kept)
           .withColumn("bad", F.col("kept") & (P.is_bad_hits(F.col("hits")) | F.col("time").isNull())))
    return out.drop("_kw") if keywords is not None else out


def file_outcomes(flagged: DataFrame, file_col: str | list[str] = "file_name") -> DataFrame:
    """Per file: rows that would load, bad rows, and ``success``/``failed`` (L4).

    One partial/final aggregate on the file key; each gzip file is read by a
    single task, so the map side already emits one row per file.
    """
    keys = [file_col] if isinstance(file_col, str) else list(file_col)
    return (flagged.groupBy(*keys)
            .agg(F.count_if(F.col("kept") & ~F.col("bad")).alias("rows_ok"),
                 F.count_if(F.col("bad")).alias("bad_rows"))
            .withColumn("status", F.when(F.col("bad_rows") > 0, F.lit("failed")).otherwise(F.lit("success"))))
