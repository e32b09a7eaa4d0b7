"""Keyword dimension.

Seeding is idempotent: only (keyword, category) pairs not yet present are
appended, so running setup twice leaves one row per pair (the reference appended the
whole seed on every run and multiplied later joins).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow import schemas as S
from pageflow.session import read_or_empty, scratch_path

# The reference's seed dimension (keyword, category), in its order.
SEED_KEYWORDS = [
    ("DuckDB", "database"),
    ("ClickHouse", "database"),
    ("PostgreSQL", "database"),
    ("Apache_Cassandra", "database"),
    ("MongoDB", "database"),
    ("Redis", "database"),
    ("Snowflake_(company)", "data_warehouse"),
    ("BigQuery", "data_warehouse"),
    ("Amazon_Redshift", "data_warehouse"),
    ("Azure_Synapse_Analytics", "data_warehouse"),
    ("Apache_Spark", "processing_engine"),
    ("Apache_Flink", "processing_engine"),
    ("Apache_Beam", "processing_engine"),
    ("Presto_(SQL_query_engine)", "processing_engine"),
    ("Apache_Kafka", "streaming"),
    ("Apache_Pulsar", "streaming"),
    ("RabbitMQ", "streaming"),
    ("Apache_Airflow", "orchestration"),
    ("Prefect_(software)", "orchestration"),
    ("Dagster", "orchestration"),
    ("dbt_(software)", "etl_tool"),
    ("Fivetran", "etl_tool"),
    ("Airbyte", "etl_tool"),
    ("Databricks", "platform"),
    ("Data_engineering", "concept"),
    ("Extract,_transform,_load", "concept"),
    ("Data_warehouse", "concept"),
    ("Data_lake", "concept"),
    ("Data_pipeline", "concept"),
]


def seed_frame(spark: SparkSession) -> DataFrame:
    """The reference seed as a DataFrame ``keyword, category``."""
    return spark.createDataFrame(SEED_KEYWORDS, "keyword STRING, category STRING")


def merge_seed(existing: DataFrame, seed: DataFrame) -> DataFrame:
    """K1: (keyword, category) rows of ``seed`` that ``existing`` lacks (to append), with ``added_date``."""
    new = seed.select("keyword", "category").distinct()
    return (new.join(existing.select("keyword", "category"), ["keyword", "category"], "left_anti")
            .withColumn("added_date", F.current_date()))


def seed_keywords(spark: SparkSession, path: str, seed: DataFrame | None = None) -> int:
    """Append the missing seed keywords to the Parquet dimension at ``path``; returns rows added."""
    seed = seed if seed is not None else seed_frame(spark)
    existing = read_or_empty(spark, path, S.KEYWORDS)
    add = merge_seed(existing, seed).select(*[F.col(f.name).cast(f.dataType) for f in S.KEYWORDS.fields])
    # Stage first: the anti join reads the table that is being appended to.
    stage = scratch_path(spark, "kw-seed")
    add.write.mode("overwrite").parquet(stage)
    staged = spark.read.parquet(stage)
    n = staged.count()
    if n:
        staged.write.mode("append").parquet(path)
    return n


def add_keyword(spark: SparkSession, path: str, keyword: str, category: str) -> int:
    """Ad hoc single keyword insert, idempotent (README example)."""
    return seed_keywords(spark, path, spark.createDataFrame([(keyword, category)], "keyword STRING, category STRING"))
