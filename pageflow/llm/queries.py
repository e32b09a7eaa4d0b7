"""One thin query for each operator: whole tables in, the contract's columns out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow.llm import (bpe, chunks, cross_polytope, decontaminate, divergence, html_crf, jaccard, prefix_trie, quality_fm,
                          quality_rules, secrets, shards, url_filter)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: The rule list that op8 is asked to apply: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow")]


def register(name: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op1_chunks")
def op1_chunks(spark, sf):
    """Runs of repeated chunks; a document without one has no row."""
    return chunks.repeats(table(spark, sf, "documents"))


@register("op2_jaccard")
def op2_jaccard(spark, sf):
    return jaccard.near_duplicates(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")


@register("op3_bpe")
def op3_bpe(spark, sf):
    coded = bpe.round_trip(table(spark, sf, "documents"), tokenizer_path())
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op4_html_crf")
def op4_html_crf(spark, sf):
    return html_crf.extract(table(spark, sf, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@register("op5_decontaminate")
def op5_decontaminate(spark, sf):
    """Leaked passages; a document without one has no row."""
    return decontaminate.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@register("op6_secrets")
def op6_secrets(spark, sf):
    found = secrets.scan(table(spark, sf, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "entropy")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
                        secrets.joined(F.col("spans")).alias("spans"))


@register("op7_quality_rules")
def op7_quality_rules(spark, sf):
    judged = quality_rules.quality_rules(table(spark, sf, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


@register("op8_url_filter")
def op8_url_filter(spark, sf):
    return url_filter.apply_rules(table(spark, sf, "pages"), url_filter.rule_table(spark, URL_RULES))


@register("op9_quality_fm")
def op9_quality_fm(spark, sf):
    docs = table(spark, sf, "documents")
    scored = quality_fm.score(docs, quality_fm.train(docs, table(spark, sf, "labels")), ["doc_id"])
    return scored.select("doc_id", quality_fm.held_out().alias("held_out"), "score",
                         (F.col("score") >= quality_fm.THRESHOLD).cast("int").alias("predicted"))


@register("op10_shards")
def op10_shards(spark, sf):
    placed = shards.shard(table(spark, sf, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@register("op11_divergence")
def op11_divergence(spark, sf):
    return divergence.audit(table(spark, sf, "documents"))


@register("op12_cross_polytope")
def op12_cross_polytope(spark, sf):
    return cross_polytope.near_vectors(table(spark, sf, "embeddings"))


@register("op13_prefix_trie")
def op13_prefix_trie(spark, sf):
    return prefix_trie.trie(table(spark, sf, "conversations"))
