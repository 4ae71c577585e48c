"""SimHash near-dedup by multi-index hashing.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, word shingles joined by
one space (repeats count; fewer words: the whole sequence; no word: fingerprint
zero).  A shingle's hash is XXH64 of its UTF-8 bytes with seed 42; a bit is 1 if
it is set in over half of the hashes.

Linking: the 64 bits are cut into two 32-bit segments.  Each distinct
fingerprint enumerates the small Hamming ball (radius ceil(max_bits / 2)) within
its segments, the other bits staying as they are, and is filed in the table
under every ball point.  Two fingerprints within ``max_bits`` meet in a ball
point, because each walks half of the differing bits towards the other.  A
table slot can only hold the ball around itself (65 fingerprints at radius 1),
so no slot is hot however the data are skewed: equal fingerprints are one row,
and a crowd of near-equal ones spreads over its ball points.  Matches fetched
from a slot are linked to the slot's smallest fingerprint after their complete
distance is verified; all members of a slot are linked through it.

Edge cases: null, empty and blank texts have fingerprint zero and are linked
like any other; repeated rows share their component; a null id is no candidate
for ``component_id`` (null if the component holds null ids only); an empty
table gives an empty result; other columns pass through unread.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, fresh, ship_by_value
from .components import components

#: Shingle hash seed (fixed value).
SEED = 42
SEGMENTS = ((0, 32), (32, 64))
_BLOCK = 1 << 16


def _fingerprint(text: bytes | None, k: int) -> int:
    words = text.lower().split() if text else []  # bytes: ASCII case and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= k:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        starts = list(accumulate((len(w) + 1 for w in words), initial=0))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b - 1], SEED) for a, b in zip(starts, starts[k:])]
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _BLOCK):
        part = np.array(hashes[i:i + _BLOCK], np.uint64).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def simhash_column(text_col: str, shingle_words: int = 3):
    """64-bit SimHash of the text as a signed long column."""
    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([_fingerprint(t, shingle_words) for t in texts], dtype="int64")
    return simhash(F.col(text_col).cast("binary"))


def _ball(radius: int) -> list[int]:
    """Signed masks of up to ``radius`` flipped bits, enumerated segment by segment."""
    per_segment = [{r: [sum(1 << b for b in bits) for bits in combinations(range(lo, hi), r)] for r in range(radius + 1)}
                   for lo, hi in SEGMENTS]
    masks = [a | b for r in range(radius + 1) for s in range(radius + 1 - r)
             for a in per_segment[0][r] for b in per_segment[1][s]]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Verified links (a, b) between distinct fingerprints (column ``fp``) that
    connect whatever differs in at most ``max_bits`` bits."""
    table = prints.select("fp", F.explode(F.array(*[F.lit(m) for m in _ball((max_bits + 1) // 2)])).alias("mask"))
    table = table.select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("slot"))
    if max_bits % 2 == 0:
        met = (table.withColumn("a", F.min("fp").over(Window.partitionBy("slot")))
               .select("a", F.col("fp").alias("b")))
    else:  # two members of a slot may be max_bits + 1 apart: compare the slot's (bounded) pairs
        met = table.join(table.select(F.col("fp").alias("a"), "slot"), "slot").select("a", F.col("fp").alias("b"))
    distance = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return met.where((F.col("a") < F.col("b")) & (distance <= max_bits)).distinct()


def _grouped(rows: DataFrame, scratch: Scratch, max_bits: int) -> DataFrame:
    """(fp, root, component) for the fingerprints of groups that hold more than one row."""
    prints = scratch.table(rows.groupBy("fp").agg(F.min("id").alias("first_id"), F.count("*").alias("n_rows")), "prints")
    roots = scratch.table(components(links(prints, max_bits), scratch), "roots")
    linked = (prints.join(roots, prints["fp"] == roots["node"], "left")
              .select("fp", F.coalesce("root", "fp").alias("root"), "first_id",
                      (F.col("node").isNotNull() | (F.col("n_rows") > 1)).alias("grouped")).where("grouped"))
    linked = scratch.table(linked.drop("grouped"), "linked")
    smallest = scratch.table(linked.groupBy("root").agg(F.min("first_id").alias("component")), "smallest")
    return scratch.table(linked.join(smallest, "root").select("fp", "root", "component"), "grouped")


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """(id, fingerprint, component_id) for every row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.table(docs.select(F.col(id_col).alias("id"), simhash_column(text_col, shingle_words).alias("fp")), "rows")
    grouped = _grouped(rows, scratch, max_bits).select(F.col("fp").alias("g_fp"), "component")
    out = rows.join(grouped, rows["fp"] == grouped["g_fp"], "left")
    component = F.when(F.col("g_fp").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      component.alias("component_id"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest id (nulls
    last), then the smallest text hash; identical rows collapse to one."""
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.table(docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tkey"),
                                     simhash_column(text_col, shingle_words).alias("fp")), "rows")
    grouped = _grouped(rows, scratch, max_bits).select(F.col("fp").alias("g_fp"), "root")
    members = scratch.table(rows.join(grouped, rows["fp"] == grouped["g_fp"]).select("id", "tkey", "root"), "members")
    lost_id, lost_key, key = fresh(docs, "lost_id", "lost_key", "text_key")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "tkey")
    best = scratch.table(members.groupBy(F.col("root").alias("b_root")).agg(F.min(order).alias("best")), "best")
    losers = (members.join(best, F.col("root") == F.col("b_root"))
              .where(~(F.col("id").eqNullSafe(F.col("best.id")) & (F.col("tkey") == F.col("best.tkey"))))
              .select(F.col("id").alias(lost_id), F.col("tkey").alias(lost_key)))
    losers = scratch.table(losers.distinct(), "losers")
    repeats = rows.groupBy("id", "tkey").count().where("count > 1").limit(1).count() > 0
    kept = (docs.withColumn(key, F.xxhash64(text_col))
            .join(losers, F.col(id_col).eqNullSafe(F.col(lost_id)) & (F.col(key) == F.col(lost_key)), "left_anti"))
    if repeats:
        kept = kept.dropDuplicates([id_col, key])
    return kept.drop(key)


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicate_groups(docs, shingle_words=3, max_bits=2)


ship_by_value(__name__)
