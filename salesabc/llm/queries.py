"""Registered queries of the operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cotraining, decontam, fingerprint, line_dedup, lm, ngram_join, packing, simhash_dup, toxicity, trie, unit_dedup, warc, whitening
from .common import table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.crc32(F.col("doc_id").cast("string")) % 3
    scored = cotraining.co_train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder != 1)
    return scored.withColumn("held_out", remainder == 1).withColumns({"predicted": (F.col("score") >= 0.5).cast("int"), "keep": F.col("score") >= 0.5})


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_pairs(table(spark, sf_dir, "documents"))


def op4_fingerprint_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.search(table(spark, sf_dir, "documents"), F.col("doc_id") % 50 == 0)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.crc32(F.col("doc_id").cast("string")) % 10
    scored = lm.score_texts(table(spark, sf_dir, "documents"), remainder != 0)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "removed_lines")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.crc32(F.col("doc_id").cast("string")) % 3
    scored = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder != 1)
    return scored.select("doc_id", (remainder == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = unit_dedup.repeated_units(table(spark, sf_dir, "documents"), unit="passage", min_words=unit_dedup.PASSAGE_WORDS)
    return removed.drop("text_key").withColumnsRenamed({"kept_id": "kept_doc_id"})


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return unit_dedup.remove_units(docs, unit_dedup.repeated_units(docs, unit="passage"), spans_col="removed_spans")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


QUERIES = {"op1_best_fit_packing": op1_best_fit_packing,
           "op2_warc": op2_warc,
           "op3_quality_classifier": op3_quality_classifier,
           "op4_document_fingerprints": op4_document_fingerprints,
           "op4_fingerprint_search": op4_fingerprint_search,
           "op5_benchmark_decontamination": op5_benchmark_decontamination,
           "op6_lm_scoring": op6_lm_scoring,
           "op7_line_dedup": op7_line_dedup,
           "op8_toxicity": op8_toxicity,
           "op9_substring_dedup": op9_substring_dedup,
           "op9_repeated_passages": op9_repeated_passages,
           "op10_simhash_near_dedup": op10_simhash_near_dedup,
           "op11_embedding_whitening": op11_embedding_whitening,
           "op12_conversation_trie": op12_conversation_trie,
           "op13_ngram_jaccard_join": op13_ngram_jaccard_join}
#: Queries that SQL can express; the tests hold the others against brute-force versions.
ORACLE: dict[str, str] = {"op7_line_dedup": line_dedup.ORACLE, "op12_conversation_trie": trie.ORACLE, "op13_ngram_jaccard_join": ngram_join.ORACLE}
