"""The corpus pipeline: quality, near duplicates, benchmark leaks, secrets, tokens.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame; ``run`` writes it as Parquet in the shared folder and
reads it again as the next stage's input. All but the last stage return the
columns of ``documents``. SQL can't express the classifier, so ORACLE_SQL is
None and the tests hold the stages against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow.llm import bpe, decontaminate, jaccard, quality_fm, secrets
from pageflow.llm.components import stored
from pageflow.llm.queries import table, tokenizer_path
from pageflow.llm.scan import free_name
from pageflow.session import scratch_path

#: Ids of documents to drop that are broadcast at most (some 32 bytes each).
BROADCAST_IDS = 1_000_000


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    A null text is scored as an empty one, whole texts of any length are scored,
    repeated rows get the same score, and without labels or documents nothing is learnt: all scores are 0.5,
    which the classifier rejects; an empty table stays empty.
    """
    model = quality_fm.train(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "score")
    scored = quality_fm.score(docs, model, docs.columns, name=score)
    return scored.where(F.col(score) >= quality_fm.THRESHOLD).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the one with the smallest id.

    Ids name documents: of rows that share id and text one stays, and rows
    without an id, which no component can name, all stay.
    """
    near = jaccard.near_duplicates(docs)
    by_id = near.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.col("doc_id") == F.col("component_id")).alias("stands"), F.count("*").alias("n"))
    by_id = stored(by_id, "near-ids")
    gone = by_id.where(~F.col("stands")).select("doc_id")
    if gone.count() <= BROADCAST_IDS:  # else the texts are shuffled to the ids
        gone = F.broadcast(gone)
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    if by_id.where((F.col("n") > 1) & F.col("stands")).isEmpty():
        return kept
    unnamed = free_name(docs, "unnamed")
    numbered = kept.withColumn(unnamed, F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()))
    return numbered.dropDuplicates(["doc_id", "text", unnamed]).select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Null and empty texts have none and stay; repeated rows share their fate; texts of any length are
    searched whole; an empty benchmark drops nothing.
    """
    leaks = free_name(docs, "leaks")
    flagged = decontaminate.flag(docs, table(spark, sf_dir, "benchmark"), docs.columns, name=leaks)
    return flagged.where(F.size(leaks) == 0).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in the text and n_chars set anew where that changed it.

    Null and empty texts and texts without secrets stay as they are, a null n_chars of an unchanged text too;
    repeated rows stay repeated; an empty table stays empty.
    """
    found = free_name(docs, "n_secrets")
    masked = secrets.redacted(docs, name=found)
    return masked.withColumn("n_chars", F.when(F.col(found) > 0, F.length("text")).otherwise(F.col("n_chars"))
                             .cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: id, number of tokens, token ids and the digest of the decoded text.

    A null text counts as empty: no tokens and the digest of the empty text. Every row has one row, repeated ones too.
    """
    coded = bpe.round_trip(docs, tokenizer_path())
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("secret scans", mask_secrets),
    ("BPE encoding and decoding", tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = scratch_path(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
