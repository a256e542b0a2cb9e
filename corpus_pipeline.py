"""Corpus pipeline: the training-data operators applied one after another to ``documents``.

Each stage takes (spark, docs, sf_dir) and works on everything that the stage
before it kept.  ``run`` writes every stage's result to the shared scratch
folder and reads it again for the next one.

A document is known by its id and a hash of its text, so rows that share an id
or have none are judged one by one.  Columns other than doc_id, text and
n_chars pass through; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesabc.llm import decontam, line_dedup, packing, simhash_dup, toxicity
from salesabc.llm.common import table, written

#: Documents that score at least this much are toxic.
TOXIC = 0.7
_TEXT = "__text_hash"


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.withColumn(_TEXT, F.xxhash64(F.col("text")))


def _same_document(docs: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """docs joined to (doc_id, text hash) rows of a written table, whose size decides between broadcast and shuffle."""
    keys = other.select(F.col("doc_id").alias("__id"), F.col(_TEXT).alias("__hash")).distinct()
    own = _hashed(docs)
    return own.join(written(keys, "keys"), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col(_TEXT) == F.col("__hash")), how).select(*docs.columns)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    learn = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    scored = toxicity.toxicity(_hashed(docs), table(spark, sf_dir, "labels"), learn, carry=(_TEXT,))
    return _same_document(docs, scored.where(F.col("score") >= TOXIC), "left_anti")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines are cut out of the texts; every document stays."""
    cut = line_dedup.dedup_lines(docs, count_col="__removed")
    if "n_chars" in docs.columns:
        changed = F.when(F.col("__removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", changed)
    return cut.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id stays."""
    found = written(simhash_dup.near_duplicates(_hashed(docs), shingle=simhash_dup.SHINGLE, radius=simhash_dup.RADIUS, carry=(_TEXT,)), "near-duplicates")
    keep = found.groupBy("component_fingerprint").agg(F.min(F.struct("doc_id", _TEXT)).alias("first")).select("first.*")
    kept = _same_document(docs, keep, "left_semi")
    repeated = found.groupBy("doc_id", _TEXT).count().where("count > 1")
    return kept if repeated.isEmpty() else kept.dropDuplicates(["doc_id", "text"])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    leaks = decontam.contaminated(_hashed(docs), table(spark, sf_dir, "benchmark"), carry=(_TEXT,))
    return _same_document(docs, leaks, "left_anti")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, tokenised and packed into sequences."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", toxicity_filter), ("line dedup", line_dedup_stage), ("SimHash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("best-fit packing", best_fit_packing)]

#: Stages beyond SQL (a trained classifier, a tokenizer); tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, name.replace(" ", "-").lower())
    return docs
