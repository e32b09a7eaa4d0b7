"""Maintenance of the fact table.

Every dedup here is a hash aggregate (partial on the map side, final after
one shuffle on the key), never a window over a whole key: a key holding a
third of all rows is reduced per task before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow.schemas import NATURAL_KEY


def drop_exact_duplicates(fact: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """M1: keep one row per identical row (or per ``keys``)."""
    return fact.dropDuplicates(list(keys)) if keys else fact.distinct()


def collapse_sum(fact: DataFrame, keys: Sequence[str] = NATURAL_KEY,
                 version_col: str = "ingestion_date") -> DataFrame:
    """M2: one row per key with ``sum(hits)`` and the newest version.

    Note (B4): after a double load this doubles hits; it is the reference's
    "dedup" query, kept as is. Use :func:`dedup_loads` to undo a double load.
    """
    aggs = [F.sum("hits").alias("hits")]
    if version_col in fact.columns:
        aggs.append(F.max(version_col).alias(version_col))
    return fact.groupBy(*keys).agg(*aggs)


def keep_latest(fact: DataFrame, keys: Sequence[str] = NATURAL_KEY,
                version_col: str = "ingestion_date") -> DataFrame:
    """M3: the row with the highest ``version_col`` per key (ReplacingMergeTree FINAL).

    Ties on the version are broken by the remaining columns in order, which
    keeps the result deterministic. With one remaining column (the fact's
    ``hits``) this is two hash aggregates: the max of that column per
    ``(key, version)``, then ``max_by(it, version)`` per key, exact because a
    key has one row per version after the first step. Otherwise it is
    ``max(struct(version, rest...))``: still a partial aggregate folded on the
    map side, but with a struct buffer, so Spark runs it sort-based (spilling).
    No key is ever gathered into one task by a window.
    """
    rest = [c for c in fact.columns if c not in keys and c != version_col]
    if len(rest) == 1:
        (r,) = rest
        per_version = fact.groupBy(*keys, version_col).agg(F.max(r).alias(r))
        return per_version.groupBy(*keys).agg(F.max(version_col).alias(version_col),
                                              F.max_by(r, version_col).alias(r))
    best = F.max(F.struct(F.col(version_col), *[F.col(c) for c in rest])).alias("_best")
    return (fact.groupBy(*keys).agg(best)
            .select(*keys, *[F.col(f"_best.{c}").alias(c) for c in [version_col, *rest]]))


def dedup_loads(fact: DataFrame, keys: Sequence[str] = NATURAL_KEY,
                load_col: str = "ingestion_date") -> DataFrame:
    """Undo repeated loads (B14): sum hits within each load, then keep the latest load per key.

    Distinct raw lines may decode to one key inside a single file, so
    row-level dedup would drop genuine hits; summing per load first keeps
    them. Both steps are partial/final hash aggregates, so each of the two
    shuffles moves rows already combined per task; a single shuffle on the
    key alone would send a hot key's raw rows to one task. After the first
    step a key has one row per load, so ``max_by(hits, load)`` is exact and
    deterministic (no ties) and stays a fixed-width hash aggregate.
    """
    per_load = fact.groupBy(*keys, load_col).agg(F.sum("hits").alias("hits"))
    return per_load.groupBy(*keys).agg(F.max(load_col).alias(load_col),
                                       F.max_by("hits", load_col).alias("hits"))


def rebuild_and_swap(spark: SparkSession, src_path: str, dst_root: str,
                     transform: Callable[[DataFrame], DataFrame], version: int = 1, table: str | None = None) -> str:
    """M4: rebuild into a new versioned location and, with ``table``, point the catalog's table there.

    Spark cannot overwrite a table it is reading, so the rebuilt table goes
    to ``{dst_root}/v{version}``, in the layout of the load, so that further
    loads can follow it there.
    """
    from pageflow.plans.ingest import read_fact, write_fact

    out = f"{dst_root.rstrip('/')}/v{version}"
    rebuilt = transform(read_fact(spark, src_path)).drop("ym", "src_file")
    write_fact(rebuilt, out)
    if table:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{out}'")
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
        spark.sql(f"REFRESH TABLE {table}")
    return out


def compact_months(spark: SparkSession, fact_path: str, dst_root: str, months: Sequence[int],
                   version: int = 1, rows_per_file: int = 5_000_000) -> str:
    """M4 for small files: rewrite closed months of the file-partitioned fact as ``ym`` partitions.

    The ``ym IN (…)`` predicate prunes the read to those months; rows are
    range-partitioned on ``(ym, path, time)`` into about ``rows / rows_per_file``
    sorted files, so a month of ~720 tiny hour files becomes a few large ones
    with tight row-group min/max on ``path``. Returns the new location.
    """
    src = spark.read.parquet(fact_path).where(F.col("ym").isin([int(m) for m in months])).drop("src_file")
    n = src.count()
    files = max(1, -(-n // rows_per_file))
    out = f"{dst_root.rstrip('/')}/v{version}"
    (src.repartitionByRange(files, "ym", "path", "time").sortWithinPartitions("ym", "path", "time")
     .write.mode("overwrite").partitionBy("ym").parquet(out))
    return out


def truncate(spark: SparkSession, path: str, schema) -> None:
    """W8 for an unpartitioned table: replace it by an empty one with the same schema."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def empty_folder(spark: SparkSession, path: str) -> None:
    """W8 for a partitioned table: remove every file and partition folder below ``path``."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(p):
        for st in fs.listStatus(p):
            fs.delete(st.getPath(), True)
    else:
        fs.mkdirs(p)
