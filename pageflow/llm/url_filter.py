"""URL filter lists by hashed expressions (operator 8).

A rule is a host and a path prefix. Each URL is expanded into the expressions a
rule could have: host suffixes at label borders and path prefixes. Only depths
and lengths that occur in the rule list are made, which loses nothing and keeps
a long URL from making many rows. Expressions and rules meet in an equi-join on
a short hash prefix; the full digest then confirms each hit, and the longest
rule wins (longest host, then longest path, then block before allow).

Expressions are taken to their distinct values before the join, so a host that
holds a third of all pages is looked up once, not once a page. The rules are
broadcast if they are few (``BROADCAST_RULES``, counted), else shuffled; the
hits go back to the pages by the same rule.

Edge cases: a null URL or one without ``://`` has empty host and path and no
rule; an empty rule list gives every page the default verdict; a rule listed
twice counts once; repeated pages are judged alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_HEX = 8
BROADCAST_RULES = 100_000
RULE_FIELDS = "host string, path string, verdict string"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    """Host and path lie apart by a character that neither can hold."""
    return F.sha2(F.concat(host, F.lit("#"), path), 256)


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def apply_rules(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                default: str = "allow") -> DataFrame:
    """Per page: id, host, path, rule (``host`` + ``path`` of the rule that wins, else null) and verdict.

    ``rules`` has the columns of ``RULE_FIELDS``. Two small sets are collected
    from it, the label counts of its hosts and the lengths of its paths.
    """
    rules = (rules.select(F.lower("host").alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"),
                          F.lower("verdict").alias("r_verdict"))
             .groupBy("r_host", "r_path").agg(F.max("r_verdict").alias("r_verdict"))  # block over allow
             .withColumn("r_digest", _digest(F.col("r_host"), F.col("r_path")))
             .withColumn("r_prefix", F.substring("r_digest", 1, PREFIX_HEX)))
    shape = rules.agg(F.collect_set(_labels(F.col("r_host"))).alias("depths"),
                      F.collect_set(F.length("r_path")).alias("lengths"), F.count("*").alias("n")).first()
    few = shape["n"] <= BROADCAST_RULES

    def side(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if few else df

    split = pages.select(F.col(f"`{id_col}`").alias("page_id"), host_of(F.col(f"`{url_col}`")).alias("host"),
                         path_of(F.col(f"`{url_col}`")).alias("path"))
    if not shape["n"]:
        return split.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    # one expression a (depth, length): a host suffix and a path prefix
    hosts = F.array_distinct(F.array(*[F.when(_labels(F.col("host")) >= d, F.substring_index("host", ".", -d))
                                       for d in sorted(shape["depths"])]))
    paths = F.array_distinct(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n))
                                       for n in sorted(shape["lengths"])]))
    expanded = split.select("*", F.transform(F.array_compact(hosts), lambda h: F.struct(
        h.alias("h"), F.array_compact(paths).alias("ps"))).alias("hs"))
    one = expanded.select("page_id", "host", "path", F.explode("hs").alias("x")).select(
        "page_id", "host", "path", F.col("x.h").alias("h"), F.explode("x.ps").alias("p"))
    digests = one.select("page_id", "host", "path", _digest(F.col("h"), F.col("p")).alias("digest"))
    wanted = digests.select("digest", F.substring("digest", 1, PREFIX_HEX).alias("prefix")).distinct()
    confirmed = (wanted.join(side(rules), F.col("prefix") == F.col("r_prefix"))
                 .where(F.col("digest") == F.col("r_digest")).select("digest", "r_host", "r_path", "r_verdict"))
    # never more rows than rules
    best = (digests.join(side(confirmed), "digest")
            .groupBy("host", "path")
            .agg(F.max(F.struct(F.length("r_host"), F.length("r_path"), "r_verdict", "r_host", "r_path")).alias("b"))
            .select("host", "path", F.concat("b.r_host", "b.r_path").alias("rule"), F.col("b.r_verdict").alias("verdict")))
    return (split.join(best, ["host", "path"], "left")
            .select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")))


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """A rule list (host, path, verdict) as a DataFrame."""
    return spark.createDataFrame(list(rules), RULE_FIELDS)
