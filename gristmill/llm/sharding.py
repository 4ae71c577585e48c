"""Sharding by proportional stratified interleaving.

Method: rows are put in a seeded random order within each stratum (source),
ranked, and given the fractional rank (rank + 1/2) / stratum size; the whole
table is sorted by fractional rank and cut into equal runs, so every shard
holds the strata in the corpus' proportions and row counts differ by at most
one (law ``rows``).

Both rankings are two-level: a row's bucket is a monotone function of its sort
key (a uniform hash, then the fractional rank, which is uniform too), counts
per bucket give offsets, and ``row_number`` runs inside a bucket.  About
sqrt(rows) buckets make a bucket and the offset table alike small; a stratum
with a third of all rows is spread over all of them.

Edge cases: a null text counts as empty (size 8, CRC 0); a null stratum is a
stratum of its own; repeated rows are ranked next to each other and each gets
its own slot; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, text_or_empty


def _offsets(rows: DataFrame, bucket: str, by: list[str]) -> DataFrame:
    """Per bucket: rows in earlier buckets (of the stratum), rows of the stratum."""
    counts = rows.groupBy(*by, bucket).agg(F.count("*").alias("_in_bucket"))
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = w.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*by, bucket, F.coalesce(F.sum("_in_bucket").over(before), F.lit(0)).alias("_before"),
                         F.sum("_in_bucket").over(w).alias("_total"))


def interleaved_shards(rows: DataFrame, strata: list[str], order_key: Column, n_shards: int,
                       ties: list[str]) -> DataFrame:
    """``rows`` plus ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).

    ``rows`` should be narrow: it is written to the scratch folder twice.
    ``order_key`` is a 64-bit hash that puts the rows of a stratum in random
    order; ``ties`` are the columns that order equal keys.
    """
    scratch = Scratch(rows.sparkSession, "sharding")
    cols = rows.columns
    stratum = F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), F.col(s).cast("string")), F.lit("null")) for s in strata])
    keyed = scratch.table(rows.withColumns({"_stratum": stratum, "_key": order_key}), "keyed")
    n = keyed.count()
    buckets = max(1, math.isqrt(n))

    share = F.col("_key").cast("double") / F.lit(2.0 ** 64) + F.lit(0.5)
    keyed = keyed.withColumn("_bucket", F.least(F.floor(share * buckets), F.lit(buckets - 1)).cast("int"))
    w = Window.partitionBy("_stratum", "_bucket").orderBy("_key", *ties)
    ranked = (keyed.join(_offsets(keyed, "_bucket", ["_stratum"]), ["_stratum", "_bucket"])
              .withColumn("_rank", F.col("_before") + F.row_number().over(w) - 1)
              .withColumn("_fraction", (F.col("_rank") + F.lit(0.5)) / F.col("_total"))
              .withColumn("_run", F.least(F.floor(F.col("_fraction") * buckets), F.lit(buckets - 1)).cast("int")))
    ranked = scratch.table(ranked.drop("_before", "_total", "_bucket", "_rank"), "ranked")

    w = Window.partitionBy("_run").orderBy("_fraction", "_stratum", "_key", *ties)
    placed = (ranked.join(_offsets(ranked, "_run", []), ["_run"])
              .withColumn("_place", F.col("_before") + F.row_number().over(w) - 1))
    shard = F.floor(F.expr(f"(_place * {n_shards}L) div {max(n, 1)}L"))
    return (placed.withColumn("_shard", shard)
            .select(*cols, F.col("_shard").cast("int").alias("shard"),
                    F.expr(f"_place - ((_shard * {n}L + {n_shards - 1}L) div {n_shards}L)").cast("long").alias("slot")))


def shard_documents(docs: DataFrame, n_shards: int = 24, seed: int = 20, id_col: str = "doc_id",
                    text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, size, text_crc32, shard, slot) per row; size is the text's UTF-8 bytes plus 8."""
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("_source"),
                       (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.xxhash64(F.lit(seed), F.col(id_col), F.col(source_col), F.col(text_col)).alias("_order"))
    out = interleaved_shards(rows, ["_source"], F.col("_order"), n_shards, ["doc_id", "size", "text_crc32"])
    return out.select(F.col("doc_id").alias(id_col), "size", "text_crc32", "shard", "slot")


def op6_stratified_shards(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return shard_documents(docs, 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
