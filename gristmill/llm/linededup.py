"""Line dedup: drop lines that many documents share, by keep bitmaps.

Method: lines are hashed; the hash rows are range-partitioned by (hash,
document) with a secondary sort by document and position, so that the copies
of a hot line spread over many partitions.  Each partition streams its sorted
run to the first occurrence per (hash, document); a partial aggregation then
gives, per hash, the number of documents and the largest id.  The result per
document is a compressed keep bitmap, never text; ``apply_bitmaps`` cuts the
text with it.

Rules: a line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and
with A-Z lower-cased.  Keys of at least ``min_chars`` code points found in at
least ``min_docs`` distinct ids lose all their lines, except in the largest id
that holds them.

Edge cases: null text counts as empty (one empty line); rows with a null id are
not counted and keep all their lines; repeated rows count as one document and
are cut alike; rows that share an id but differ in text count as one document
and each is cut by its own bitmap; an empty table gives an empty result; other
columns of the input never clash (only the id and the text are read, the rest
passes through).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, ascii_lower, fresh, shuffle_partitions, text_or_empty

#: White space stripped from a line's ends (fixed value).
LINE_SPACE = " \t\n\x0b\x0c\r"

BITMAP = "array<struct<word:int,keep:bigint>>"


def _lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(doc, tkey, pos, h1, h2) per long line; 96 bits of hash per key."""
    lines = (docs.where(F.col(id_col).isNotNull() & (F.length(text_col) >= min_chars))
             .select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("tkey"),
                     F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("pos", "line")))
    key = F.btrim(F.col("line"), F.lit(LINE_SPACE))
    return (lines.where(F.length("line") >= min_chars)
            .select("doc", "tkey", "pos", ascii_lower(key).alias("key"))
            .where(F.length("key") >= min_chars)
            .select("doc", "tkey", "pos", F.xxhash64("key").alias("h1"), F.hash("key").alias("h2")))


def first_occurrences(lines: DataFrame) -> DataFrame:
    """The first line (h1, h2, doc, pos) per hash and document, streamed from sorted range partitions:
    the window's sort (hash, document, position) runs inside them, without another shuffle."""
    ranged = lines.select("h1", "h2", "doc", "pos").repartitionByRange(shuffle_partitions(lines.sparkSession), "h1", "h2", "doc")
    run = Window.partitionBy("h1", "h2", "doc").orderBy("pos")
    return ranged.withColumn("place", F.row_number().over(run)).where("place = 1").drop("place")


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = 40, min_docs: int = 5, scratch: Scratch | None = None) -> DataFrame:
    """One row (id, tkey, keep_bitmap) per distinct (id, text) that loses a line.

    ``tkey`` is xxhash64 of the text.  ``keep_bitmap`` holds 64 lines a word,
    bit 1 = keep; words in which every line stays are left out.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "linededup")
    lines = scratch.table(_lines(docs, id_col, text_col, min_chars), "lines")
    first = first_occurrences(lines)
    shared = (first.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc").alias("keeper"))
              .where(F.col("n_docs") >= min_docs).select("h1", "h2", "keeper"))
    shared = scratch.table(shared, "shared")
    dropped = (lines.join(shared, ["h1", "h2"]).where(F.col("doc") < F.col("keeper"))
               .groupBy("doc", "tkey", F.shiftright("pos", 6).alias("word"))
               .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos") % 64)).alias("bits")))
    return (dropped.groupBy("doc", "tkey")
            .agg(F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("keep"))))
                 .cast(BITMAP).alias("keep_bitmap"))
            .withColumnRenamed("doc", id_col))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the kept text in ``text_col``, and the counts ``_n_lines`` (before) and
    ``_n_dropped`` (columns of these names are replaced).  Every row of ``docs`` stays."""
    text = text_or_empty(text_col)
    cols = [c for c in docs.columns if c not in ("_n_lines", "_n_dropped")]
    doc, tkey, bits, key, kept_lines, lines = fresh(docs, "doc", "tkey", "bits", "text_key", "kept_lines", "lines")
    b = bitmaps.select(F.col(id_col).alias(doc), F.col("tkey").alias(tkey), F.col("keep_bitmap").alias(bits))
    joined = (docs.select(*cols, F.xxhash64(text_col).alias(key))
              .join(b, (F.col(id_col) == F.col(doc)) & (F.col(key) == F.col(tkey)), "left"))
    words = F.map_from_entries(bits)
    kept = F.filter(F.split(text, "\n", -1),
                    lambda line, i: F.coalesce(F.getbit(F.try_element_at(words, F.shiftright(i, 6)), i % 64), F.lit(1)) == 1)
    n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    cut = joined.withColumns({kept_lines: F.when(F.col(bits).isNotNull(), kept), lines: n_lines})
    whole = F.col(kept_lines).isNull()
    return cut.select(
        *[F.when(whole, text).otherwise(F.array_join(kept_lines, "\n")).alias(c) if c == text_col else F.col(c) for c in cols],
        F.col(lines).cast("long").alias("_n_lines"),
        F.when(whole, F.lit(0)).otherwise(F.col(lines) - F.size(kept_lines)).cast("long").alias("_n_dropped"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Every row of ``docs`` with its shared lines cut, plus ``_n_lines`` and ``_n_dropped``."""
    return apply_bitmaps(docs, keep_bitmaps(docs, id_col, text_col, min_chars, min_docs), id_col, text_col)


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = dedup_lines(docs)
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
                      F.sha2("text", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), s AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), m AS (
  SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id < s.keeper AS gone
  FROM k LEFT JOIN s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
