"""Corpus pipeline: filter, clean, deduplicate, decontaminate and tokenise ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the result is
written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from gristmill.llm import bpe, decontaminate, linededup, quality, simhash
from gristmill.llm.common import Scratch


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality.score_documents(docs, labels, threshold=0.3).where("predicted = 1").drop("score", "predicted")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines that many documents share; every document stays."""
    out = linededup.dedup_lines(docs).drop("_n_lines", "_n_dropped")
    return out.withColumn("n_chars", F.length("text").cast("long"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.drop_near_duplicates(docs, shingle_words=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token count, and digests of its ids and of the decoded bytes."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality filter", quality_filter),
    ("line dedup", line_dedup),
    ("simhash near-dedup", simhash_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", byte_bpe),
]

#: The stages run a trained model, hashing and a tokenizer that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.table(docs, name.replace(" ", "-"))
    return docs
