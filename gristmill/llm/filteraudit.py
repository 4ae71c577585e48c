"""Filter interaction audit: what every order of five document filters removes, by part.

Method: one pass over the texts gives each document a pass/fail bit per filter
(a small integer code); documents are counted per (part, code), and each part's 32
counts are a 2x2x2x2x2 contingency tensor, axis k = filter k, index 0 = pass, 1 = fail.
For every order and step an ``einsum`` contracts the tensor with one selector per axis:
pass ``[1, 0]``, fail ``[0, 1]`` or all ``[1, 1]``.  Kept is "pass" on the axes so
far; removed is "fail" here and "pass" before; redundant is all failures here less the
removed; a unique failure is "fail" here and "pass" on every other axis.  Three tensors
(documents, good ones, toxic ones) go through the same selectors.

Filters, over words ``[^\\x20\\x09-\\x0D]+`` (case-sensitive):
A under 200 words; B distinct words under 50 % of the words; C capitals A-Z over 3 %
of the code points; D any of ``#$%&*|``; E text equal to a smaller id's text.

Copies of a text are found by its SHA-256.  A document fails E if its id is larger than
the text's smallest id.  Rows are counted per (digest, part, labels, id) and then per
(digest, part, labels) with map-side combine, so a text that a third of all rows share
shrinks to a few rows before any shuffle gathers it.

Edge cases: null text is empty (fails A only, and E if copied); null part is the empty
string; a null id never fails E, is no smaller id and has no labels; repeated rows
count each, and do not fail E by each other; an id with several label rows is good or
toxic if any row says so; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, ship_by_value, text_or_empty

FILTERS = "ABCDE"
#: Limits of the filters and the characters of C and D (fixed values).
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 3
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = b"#$%&*|"

MEASURES = ("docs", "good", "toxic")
AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")


def _text_code(text: bytes | None) -> int:
    """Bits 0-3: fails A, B, C, D."""
    text = text or b""
    words = text.split()  # bytes: ASCII white space only
    n = len(words)
    capitals = len(text) - len(text.translate(None, CAPITALS))
    code_points = len(text) if text.isascii() else len(text.decode("utf-8", "replace"))
    return ((n < MIN_WORDS)
            | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * n) << 1
            | (100 * capitals > MAX_CAPITAL_PERCENT * code_points) << 2
            | (len(text.translate(None, SYMBOLS)) < len(text)) << 3)


def text_code(text_col: str) -> Column:
    """Failures of the filters that look at one text: bit k is filter k of ABCD."""
    @F.pandas_udf("int")
    def code(texts: pd.Series) -> pd.Series:
        return pd.Series([_text_code(t) for t in texts], dtype="int32")
    return code(F.col(text_col).cast("binary"))


def contingency(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                part_col: str = "lang") -> DataFrame:
    """(part, code, docs, good, toxic): documents per part and failure code; bit k is filter k."""
    scratch = Scratch(docs.sparkSession, "filteraudit")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.sha2(text_or_empty(text_col), 256).alias("digest"), text_code(text_col).alias("code"))
    rows = scratch.table(rows, "codes")
    marks = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    known = rows.where("id is not null").join(marks, "id", "left").select(
        "id", "part", "digest", "code", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")])
    nameless = rows.where("id is null").select("id", "part", "digest", "code", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    cell = ["digest", "code", "part", "good", "toxic"]
    cells = (known.unionByName(nameless).groupBy(*cell, "id").agg(F.count("*").alias("n"))
             .groupBy(*cell).agg(F.sum("n").alias("n"), F.min("id").alias("first"),
                                 F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
                                 F.min_by("n", "id").alias("n_first")))
    # at most (parts x 4) rows a digest from here on
    smallest = F.min("first").over(Window.partitionBy("digest"))
    originals = F.col("nameless") + F.when(F.col("first") == F.col("smallest"), F.col("n_first")).otherwise(0)
    split = cells.withColumn("smallest", smallest).select("part", "code", "good", "toxic", F.explode(F.array(
        F.struct(F.lit(0).alias("copy"), originals.alias("n")),
        F.struct(F.lit(1 << 4).alias("copy"), (F.col("n") - originals).alias("n")))).alias("e"))
    return (split.groupBy("part", (F.col("code") + F.col("e.copy")).alias("code"))
            .agg(F.sum("e.n").alias("docs"), F.sum(F.col("e.n") * F.col("good")).alias("good"),
                 F.sum(F.col("e.n") * F.col("toxic")).alias("toxic")))


PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)


def _selectors(choose) -> np.ndarray:
    """(order, step, axis, 2): ``choose(axis's place in the order, step)`` picks pass, fail or all."""
    n = len(FILTERS)
    return np.array([[[choose(order.index(axis), step) for axis in range(n)] for step in range(n)]
                     for order in permutations(range(n))], np.int64)


def _contract(tensors: np.ndarray, selectors: np.ndarray) -> np.ndarray:
    """Tensors (part, measure, 2, 2, 2, 2, 2) under selectors (order, step, axis, 2): (part, measure, order, step)."""
    return np.einsum("pmabcde,osa,osb,osc,osd,ose->pmos", tensors, *np.moveaxis(selectors, 2, 0), optimize=True)


def _audits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    n = len(FILTERS)
    orders = list(permutations(range(n)))
    kept_by = _selectors(lambda at, step: PASS if at <= step else ALL)
    removed_by = _selectors(lambda at, step: PASS if at < step else FAIL if at == step else ALL)
    failed_by = _selectors(lambda at, step: FAIL if at == step else ALL)
    only_by = _selectors(lambda at, step: FAIL if at == step else PASS)
    axis = np.array(orders)  # the filter at each (order, step)
    for batch in batches:
        for lo in range(0, len(batch), 64):
            parts = batch.iloc[lo:lo + 64]
            # count c of code bits e..a: reversed, so that axis 0 is filter A
            cells = np.array([np.stack([np.asarray(row[m], np.int64) for m in MEASURES]) for _, row in parts.iterrows()])
            tensors = cells.reshape(len(parts), len(MEASURES), *[2] * n).transpose(0, 1, *range(n + 1, 1, -1))
            kept, removed, failed, only = (_contract(tensors, s) for s in (kept_by, removed_by, failed_by, only_by))
            for p, part in enumerate(parts["part"]):
                here = removed[p, 0]
                shapley = np.array([here[axis == f].sum() for f in range(n)])
                yield pd.DataFrame({
                    "part": part, "filter_order": np.repeat(["".join(FILTERS[f] for f in o) for o in orders], n),
                    "step": np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders)),
                    "kept": kept[p, 0].ravel(), "removed": here.ravel(), "redundant": (failed[p, 0] - here).ravel(),
                    "unique_fails": only[p, 0].ravel(), "good_lost": removed[p, 1].ravel(),
                    "toxic_lost": removed[p, 2].ravel(), "shapley": shapley[axis].ravel()})


def audit(counts: DataFrame) -> DataFrame:
    """Every (part, order, step) of a contingency table (part, code, docs, good, toxic)."""
    codes = range(1 << len(FILTERS))
    tensors = counts.groupBy("part").agg(*[
        F.array(*[F.coalesce(F.sum(F.when(F.col("code") == c, F.col(m))), F.lit(0)) for c in codes]).alias(m) for m in MEASURES])
    return tensors.mapInPandas(_audits, AUDIT)


def op11_filter_audit(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    return audit(contingency(docs, labels))


OP11_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS smallest
  FROM documents
), f AS (
  SELECT doc_id, part, len(words) < 200 AS A, 100 * len(list_distinct(words)) < 50 * len(words) AS B,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS C,
         regexp_matches(text, '[#$%&*|]') AS D, coalesce(doc_id > smallest, false) AS E
  FROM w
), m AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels GROUP BY doc_id
), d AS (
  SELECT part, [A, B, C, D, E] AS fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM f LEFT JOIN m USING (doc_id)
), n AS (
  SELECT part, fails, count(*) AS docs, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM d GROUP BY ALL
), l AS (SELECT unnest([1, 2, 3, 4, 5]) AS i), o AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS fs
  FROM l a JOIN l b ON b.i <> a.i JOIN l c ON c.i NOT IN (a.i, b.i) JOIN l d ON d.i NOT IN (a.i, b.i, c.i)
  JOIN l e ON e.i NOT IN (a.i, b.i, c.i, d.i)
), s AS (
  SELECT list_aggregate(list_transform(fs, lambda x: chr(CAST(64 + x AS INTEGER))), 'string_agg', '') AS filter_order, fs, i AS step FROM o, l
), c AS (
  SELECT part, filter_order, step, fs[step] AS f, docs, good, toxic, fails[fs[step]] AS here,
         coalesce(list_bool_or(list_transform(fs[1:step - 1], lambda x: fails[x])), false) AS before,
         len(list_filter(fails, lambda x: x)) AS n_fails
  FROM n, s
), r AS (
  SELECT part, filter_order, step, any_value(f) AS f,
         coalesce(sum(docs) FILTER (NOT before AND NOT here), 0) AS kept,
         coalesce(sum(docs) FILTER (here AND NOT before), 0) AS removed,
         coalesce(sum(docs) FILTER (here AND before), 0) AS redundant,
         coalesce(sum(docs) FILTER (here AND n_fails = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (here AND NOT before), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (here AND NOT before), 0) AS toxic_lost
  FROM c GROUP BY part, filter_order, step
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM r
"""

ship_by_value(__name__)
