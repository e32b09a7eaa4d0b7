"""Article text measures as pure Column expressions.

Evaluated per row on the whole text, without Python.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: lower-cased substrings searched
# in the text, the title pattern, the four counted keywords with their output
# names, and the paragraph separator (two real newlines).
TOPIC_TERMS = [
    "data engineering",
    "data pipeline",
    "etl",
    "data warehouse",
    "data lake",
    "apache spark",
    "apache kafka",
    "dbt",
    "airflow",
]
TITLE_PATTERN = "%data%engineering%"
MENTION_TERMS = {
    "de_mentions": "data engineering",
    "etl_mentions": "etl",
    "pipeline_mentions": "data pipeline",
    "spark_mentions": "apache spark",
}
PARAGRAPH_SEP = "\n\n"
TOP_N = 100


def topic_flag(terms: Sequence[str] = TOPIC_TERMS, title_pattern: str | None = TITLE_PATTERN) -> Column:
    """A1: 1 if the lower-cased text contains any term (literal substring) or the title matches.

    The text is bound to a variable after lower-casing, so it is lower-cased
    once, not once a term wherever Catalyst moves the condition.
    """
    cond = F.exists(F.array(F.lower(F.col("text"))), lambda low: reduce(or_, [low.contains(F.lit(t)) for t in terms])) if terms else None
    if title_pattern is not None:
        c = F.lower(F.col("title")).like(title_pattern)
        cond = c if cond is None else cond | c
    if cond is None:
        return F.lit(0)
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def article_length() -> Column:
    """A2: characters in the text."""
    return F.length(F.col("text"))


def mention_count(term: str) -> Column:
    """A3: occurrences of ``term`` in the lower-cased text, by length difference (float)."""
    t = F.lit(term)
    return ((F.length(F.col("text")) - F.length(F.replace(F.lower(F.col("text")), t, F.lit(""))))
            / F.length(t))


def first_paragraph(sep: str = PARAGRAPH_SEP) -> Column:
    """A4: text before the first ``sep``."""
    return F.split_part(F.col("text"), F.lit(sep), F.lit(1))
