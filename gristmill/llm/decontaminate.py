"""Benchmark decontamination: size-partitioned MinHash containment search.

Texts are lower-cased and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``;
shingles are five words (fewer words: the whole sequence, so an item under five
words is found only in a document that equals it).  An item is found in
a document if at least ``threshold`` of its distinct shingles occur there.

Search: items are partitioned by size (powers of two of their distinct
shingles).  A partition with upper size u keeps a bottom-s MinHash sketch of
each item, s = u - ceil(threshold * u) + 1.  An item contained at the threshold
misses at most s - 1 shingles, so at least one sketch hash occurs in the
document, however long that is: the search loses nothing.  Documents probe the
sketch table with all their shingle hashes.  Candidates are verified by exact
containment of the shingles' text.

The sketch table is broadcast if it has at most ``broadcast_rows`` rows (24
bytes each), else it is joined by a shuffle.

Edge cases: null, empty and word-free texts have no shingle (such an item is
found nowhere); repeated rows of documents each get their rows; repeated items
count once, and if one item_id has several texts the best one counts; an empty
table on either side gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, fresh

#: What separates words: every ASCII character that is no letter or digit (fixed value).
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str | Column) -> Column:
    return F.array_remove(F.split(F.lower(text), NO_WORD), "")


def _starts(k: int) -> Column:
    """Positions (from 1) of the k-word shingles of column ``w``; the whole sequence if shorter."""
    return F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (k - 1)))


def _shingle_hashes(k: int) -> Column:
    return F.transform(_starts(k), lambda i: F.xxhash64(F.slice("w", i, k)))


def _shingle_texts(k: int) -> Column:
    return F.array_distinct(F.transform(_starts(k), lambda i: F.array_join(F.slice("w", i, k), " ")))


def _need(n, threshold: float):
    """Shingles of ``n`` that must be found; exact at ratios such as 4 of 5."""
    return F.ceil(n * F.lit(threshold) - F.lit(1e-9)).cast("int")


def item_sketches(items: DataFrame, threshold: float) -> DataFrame:
    """(hash, item_id): the bottom-s MinHash sketch of every item, s by size partition."""
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(F.size("shingles").cast("double")))).cast("int")
    sketch = F.slice(F.array_sort(F.transform("shingles", lambda s: F.xxhash64(F.split(s, " ")))),
                     F.lit(1), upper - _need(upper, threshold) + 1)
    return items.select("item_id", F.explode(sketch).alias("hash")).select("hash", "item_id").distinct()


def find_items(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", shingle_words: int = 5,
               threshold: float = 0.8, broadcast_rows: int = 1_000_000) -> DataFrame:
    """(id, _text_key, item, n_shingles, n_found, containment) per distinct (id, text) and item."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    k = shingle_words
    items = (bench.select(F.col(item_col).alias("item_id"), words(item_text_col).alias("w")).where(F.size("w") > 0)
             .select("item_id", _shingle_texts(k).alias("shingles")).distinct())
    items = scratch.table(items, "items")
    sketches = scratch.table(item_sketches(items, threshold), "sketches")
    if sketches.count() <= broadcast_rows:
        sketches = F.broadcast(sketches)

    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tkey"), F.col(text_col).alias("text"))
    probes = (keyed.select("id", "tkey", words("text").alias("w")).where(F.size("w") > 0)
              .select("id", "tkey", F.explode(_shingle_hashes(k)).alias("hash")))
    found = probes.join(sketches, "hash").select("id", "tkey", "item_id").distinct()
    # collect_list leaves nulls out, so the item id (which may be null) is put in a struct
    found = scratch.table(found.groupBy(F.col("id").alias("c_id"), F.col("tkey").alias("c_key"))
                          .agg(F.collect_list(F.struct("item_id")).alias("item_ids")), "candidates")

    whole = (keyed.join(found, F.col("id").eqNullSafe(F.col("c_id")) & (F.col("tkey") == F.col("c_key")))
             .dropDuplicates(["id", "tkey"])
             .select("id", "tkey", "item_ids", words("text").alias("w"))
             .select("id", "tkey", _shingle_texts(k).alias("doc_shingles"), F.explode(F.col("item_ids")["item_id"]).alias("c_item")))
    n, hit = F.size("shingles"), F.size(F.array_intersect("shingles", "doc_shingles"))
    verified = (whole.join(items, F.col("c_item").eqNullSafe(F.col("item_id")))
                .select("id", "tkey", "item_id", n.alias("n_shingles"), hit.alias("n_found"))
                .where(F.col("n_found") >= _need(F.col("n_shingles"), threshold))
                .groupBy("id", "tkey", "item_id")
                .agg(F.max(F.struct((F.col("n_found") / F.col("n_shingles")).alias("c"), "n_shingles", "n_found")).alias("m")))
    return verified.select(F.col("id").alias(id_col), F.col("tkey").alias("_text_key"), F.col("item_id").alias(item_col),
                           F.col("m.n_shingles").cast("long").alias("n_shingles"),
                           F.col("m.n_found").cast("long").alias("n_found"), F.col("m.c").alias("containment"))


def drop_contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item."""
    hits = find_items(docs, bench, id_col, text_col, **kw)
    hit_id, hit_key = fresh(docs, "hit_id", "hit_key")
    hits = Scratch(docs.sparkSession, "contaminated").table(
        hits.select(F.col(id_col).alias(hit_id), F.col("_text_key").alias(hit_key)).distinct(), "hits")
    return docs.join(hits, F.col(id_col).eqNullSafe(F.col(hit_id)) & (F.xxhash64(text_col) == F.col(hit_key)), "left_anti")


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return find_items(docs, bench).select("doc_id", "item_id", "n_shingles", "n_found", "containment")


OP5_SQL = r"""
WITH dw AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), bw AS (
  SELECT item_id, list_filter(string_split_regex(lower(text), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), ds AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(2, len(w) - 3)),
                                                lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM dw WHERE len(w) > 0
), bs AS (
  SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(2, len(w) - 3)),
                                                 lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM bw WHERE len(w) > 0
), n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id
), h AS (
  SELECT doc_id, item_id, count(*) AS n_found FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, n_shingles, n_found, n_found / n_shingles AS containment
FROM h JOIN n USING (item_id) WHERE n_found * 5 >= n_shingles * 4
"""
