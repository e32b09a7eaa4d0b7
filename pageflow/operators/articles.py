"""Topic mining over an article corpus.

All measures (``functions/text.py``) are built-in string expressions
evaluated per row on the whole text, never a prefix. The top-k is a
``TakeOrderedAndProject`` (per-partition top-k, then a merge), not a full sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow.functions.text import (  # noqa: F401 - re-exported
    MENTION_TERMS,
    PARAGRAPH_SEP,
    TITLE_PATTERN,
    TOP_N,
    TOPIC_TERMS,
    article_length,
    first_paragraph,
    mention_count,
    topic_flag,
)


def flag_articles(articles: DataFrame, terms: Sequence[str] = TOPIC_TERMS,
                  title_pattern: str | None = TITLE_PATTERN) -> DataFrame:
    """A1/A2: ``id, title, text, url, article_length, is_data_engineering``."""
    return articles.select("id", "title", "text", "url",
                           article_length().alias("article_length"),
                           topic_flag(terms, title_pattern).alias("is_data_engineering"))


def mention_columns(mentions: dict[str, str] = MENTION_TERMS) -> list[Column]:
    return [mention_count(t).alias(name) for name, t in mentions.items()]


def top_articles(articles: DataFrame, terms: Sequence[str] = TOPIC_TERMS,
                 title_pattern: str | None = TITLE_PATTERN, n: int = TOP_N,
                 mentions: dict[str, str] = MENTION_TERMS, sep: str = PARAGRAPH_SEP) -> DataFrame:
    """A5: the ``n`` longest matching articles with mention counts and summary (ties by id).

    Only ids and lengths meet in the one task that merges the partitions' top
    ``n``; those ``n`` rows are broadcast, and the texts of the winners alone
    are counted and summed up where they are read.
    """
    f = flag_articles(articles, terms, title_pattern).where(F.col("is_data_engineering") == 1)
    order = [F.desc("article_length"), F.asc("id")]
    top = f.select("id", "article_length").orderBy(*order).limit(n)
    winners = f.join(F.broadcast(top), ["id", "article_length"], "left_semi")
    return (winners.select("id", "title", "url", "article_length", *mention_columns(mentions),
                           first_paragraph(sep).alias("summary"))
            .orderBy(*order).limit(n).drop("id"))


def export_matching(articles: DataFrame, path: str, terms: Sequence[str] = TOPIC_TERMS,
                    title_pattern: str | None = TITLE_PATTERN) -> str:
    """Write every matching article (with its flag columns) as Parquet."""
    (flag_articles(articles, terms, title_pattern).where(F.col("is_data_engineering") == 1)
     .write.mode("overwrite").parquet(path))
    return path
