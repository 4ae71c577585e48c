"""Sources, projections, predicates, arithmetic, math and binning queries
(S1-S3, P1-P21, N1-N5, B1-B7)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import binning as B
from ..functions import columns as C
from ..functions import strings as ST
from ..functions.dates import season
from ..operators.quantile import global_quantiles
from ..session import ensure_checkpoint_dir
from ..sources import io
from .inputs import O, O_SQL, T as tbl, wide
from .registry import register

R6 = 6


def r(c, n=R6):
    return F.round(C.col_of(c).cast("double"), n)


# ---- S1 / S4: CSV round trip ---------------------------------------------------------

NATION_SCHEMA = T.StructType([T.StructField("n_nationkey", T.IntegerType()),
                              T.StructField("n_name", T.StringType()),
                              T.StructField("n_regionkey", T.IntegerType())])


@register("scan_csv_roundtrip", sql="SELECT n_nationkey, n_name, n_regionkey FROM nation")
def scan_csv_roundtrip(spark, d):
    # written under the session's shared checkpoint folder, never a local temp dir
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/csv-roundtrip-{uuid.uuid4().hex}"
    io.write_csv(tbl(spark, d, "nation"), path)
    return io.read_csv(spark, path, NATION_SCHEMA)


_NA = ", ".join("'" + t + "'" for t in io.NA_TOKENS)


@register("scan_csv_documents", sql=f"""
SELECT doc_id, CASE WHEN text IN ({_NA}) THEN NULL ELSE text END AS text, lang, n_chars FROM documents""")
def scan_csv_documents(spark, d):
    """Free text with newlines and quotes through CSV and back, every row."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv-documents-{uuid.uuid4().hex}"
    columns = ["doc_id", "text", "lang", "n_chars"]
    docs = tbl(spark, d, "documents").select(*columns)
    io.write_csv(docs, path)
    return io.read_csv(spark, path, docs.schema)


# ---- S2, S3, P5, P6: stacking ---------------------------------------------------------

@register("stack_train_test", sql="""
SELECT c_custkey AS key, c_name AS name, c_acctbal AS acctbal, 1 AS is_train FROM customer
UNION ALL
SELECT s_suppkey, s_name, NULL, 0 FROM supplier""")
def stack_train_test(spark, d):
    train = tbl(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                                             F.col("c_acctbal").alias("acctbal"))
    test = tbl(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return io.stack_train_test(train, test)


@register("stack_renamed_source", sql="""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
UNION ALL
SELECT s_suppkey, s_name, NULL, s_acctbal, NULL FROM supplier""")
def stack_renamed_source(spark, d):
    renames = {"s_suppkey": "c_custkey", "s_name": "c_name", "s_nationkey": "c_nationkey",
               "s_acctbal": "c_acctbal"}
    return io.stack_renamed(tbl(spark, d, "customer"), tbl(spark, d, "supplier"), renames, drop=["c_nationkey"])


# ---- P1: split labels by predicate ----------------------------------------------------

@register("split_by_predicate", sql=f"""
WITH {O_SQL}
SELECT o_orderkey,
  CASE WHEN is_train THEN 'train' ELSE 'test' END AS part_sentinel,
  CASE WHEN o_orderkey < 5000 OR o_orderkey > 10000 THEN 'train' ELSE 'test' END AS part_range,
  CAST(contains(o_orderpriority, 'URGENT') AS INTEGER) AS urgent
FROM O""")
def split_by_predicate(spark, d):
    k = F.col("o_orderkey")
    return O(spark, d).select(
        "o_orderkey",
        F.when(F.col("is_train"), "train").otherwise("test").alias("part_sentinel"),
        F.when((k < 5000) | (k > 10000), "train").otherwise("test").alias("part_range"),
        F.col("o_orderpriority").contains("URGENT").cast("int").alias("urgent"))


# ---- P2, P3: numeric sweep -------------------------------------------------------------

@register("cast_numeric_sweep", sql="""
SELECT CAST(p_partkey AS DOUBLE) AS p_partkey, p_name, p_brand, p_type,
       coalesce(CAST(p_size AS DOUBLE), 0.0) AS p_size, coalesce(p_retailprice, 0.0) AS p_retailprice
FROM part""")
def cast_numeric_sweep(spark, d):
    return C.cast_numeric(tbl(spark, d, "part"), fill=0.0)


# ---- P4: tolerant parse ----------------------------------------------------------------

@register("parse_numeric_coerce", sql="""
SELECT p_partkey, TRY_CAST(trim(string_split(p_brand, '#')[-1]) AS DOUBLE) AS brand_num,
       TRY_CAST(trim(split_part(p_name, ' ', 1)) AS DOUBLE) AS name_num
FROM part""")
def parse_numeric_coerce(spark, d):
    p = tbl(spark, d, "part")
    return p.select("p_partkey", C.to_number(F.element_at(F.split("p_brand", "#"), -1)).alias("brand_num"),
                    C.to_number(F.split_part("p_name", F.lit(" "), F.lit(1))).alias("name_num"))


# ---- P8, N5: conditional overwrite ----------------------------------------------------

@register("conditional_overwrite", sql="""
SELECT c_custkey, CASE WHEN c_acctbal >= 1 THEN c_acctbal ELSE 0.5 END AS bal,
       CASE WHEN c_acctbal < 0 THEN 'DEBT' ELSE c_mktsegment END AS seg
FROM customer""")
def conditional_overwrite(spark, d):
    c = tbl(spark, d, "customer")
    return c.select("c_custkey", C.substitute_below("c_acctbal", 1, 0.5).alias("bal"),
                    F.when(F.col("c_acctbal") < 0, F.lit("DEBT")).otherwise(F.col("c_mktsegment")).alias("seg"))


# ---- P9, P10: remaps -------------------------------------------------------------------

SEGMENT_SHORT = {"BUILDING": "B", "MACHINERY": "M", "HOUSEHOLD": "H"}
SEGMENT_CODE = {"BUILDING": 1, "MACHINERY": 2, "HOUSEHOLD": 3}


@register("remap_keep", sql="""
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'B' WHEN 'MACHINERY' THEN 'M'
                  WHEN 'HOUSEHOLD' THEN 'H' ELSE c_mktsegment END AS seg FROM customer""")
def remap_keep(spark, d):
    return tbl(spark, d, "customer").select("c_custkey", C.remap("c_mktsegment", SEGMENT_SHORT).alias("seg"))


@register("remap_null", sql="""
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2
                  WHEN 'HOUSEHOLD' THEN 3 END AS seg_code FROM customer""")
def remap_null(spark, d):
    return tbl(spark, d, "customer").select(
        "c_custkey", C.remap("c_mktsegment", SEGMENT_CODE, keep_unmatched=False).alias("seg_code"))


# ---- P11: substring categorise -------------------------------------------------------

@register("categorise_substring", sql="""
SELECT p_partkey, CASE WHEN contains(p_name, 'ring') THEN 'Ring' WHEN contains(p_name, 'rod') THEN 'Rod'
                  ELSE 'Other' END AS kind FROM part""")
def categorise_substring(spark, d):
    return tbl(spark, d, "part").select(
        "p_partkey", C.categorise_by_substring("p_name", [("ring", "Ring"), ("rod", "Rod")], "Other").alias("kind"))


# ---- P12: pattern-set membership ----------------------------------------------------

@register("flag_pattern_membership", sql="""
WITH n AS (SELECT o_orderkey, o_orderkey % 1000 AS n FROM orders)
SELECT o_orderkey, CAST(n BETWEEN 1 AND 9 OR (n BETWEEN 10 AND 90 AND n % 10 = 0) OR (n >= 100 AND n % 100 = 0)
  OR (n >= 100 AND n // 100 = n % 10) OR (n >= 100 AND abs(n // 100 - (n // 10) % 10) = 1 AND n % 10 > 0
      AND (n // 10) % 10 - n // 100 = n % 10 - (n // 10) % 10) AS INTEGER) AS prestigious FROM n""")
def flag_pattern_membership(spark, d):
    o = tbl(spark, d, "orders")
    return o.select("o_orderkey", F.coalesce(ST.is_round_or_patterned(F.col("o_orderkey") % 1000).cast("int"), F.lit(0))
                    .alias("prestigious"))


# ---- P13, P14, P15: flags on lineitem, per order -------------------------------------

L_NULLED = """L AS (SELECT l_orderkey, l_quantity, l_tax,
  CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_discount END AS disc_n FROM lineitem)"""


def _lineitem_nulled(spark, d):
    li = tbl(spark, d, "lineitem")
    return li.select("l_orderkey", "l_quantity", "l_tax",
                     F.when(F.col("l_linenumber") % 3 == 0, F.lit(None).cast("double"))
                      .otherwise(F.col("l_discount")).alias("disc_n"))


@register("binary_flags", sql=f"""
WITH {L_NULLED}
SELECT l_orderkey, CAST(sum(CAST(coalesce(disc_n > 0, false) AS INTEGER)) AS BIGINT) AS n_disc,
       CAST(sum(CAST(l_tax > 0 AS INTEGER)) AS BIGINT) AS n_tax,
       CAST(sum(CAST(l_quantity > 25 AS INTEGER)) AS BIGINT) AS n_bigqty
FROM L GROUP BY l_orderkey""")
def binary_flags(spark, d):
    li = _lineitem_nulled(spark, d)
    return li.groupBy("l_orderkey").agg(
        F.sum(C.flag(F.col("disc_n") > 0)).cast("long").alias("n_disc"),
        F.sum(C.flag(F.col("l_tax") > 0)).cast("long").alias("n_tax"),
        F.sum(C.flag(F.col("l_quantity") > 25)).cast("long").alias("n_bigqty"))


@register("any_positive", sql=f"""
WITH {L_NULLED}
SELECT l_orderkey, CAST(sum(CAST((coalesce(disc_n, 0) > 0) OR (coalesce(l_tax, 0) > 0) AS INTEGER)) AS BIGINT)
       AS n_any FROM L GROUP BY l_orderkey""")
def any_positive(spark, d):
    li = _lineitem_nulled(spark, d)
    return li.groupBy("l_orderkey").agg(
        F.sum(C.any_positive(["disc_n", "l_tax"]).cast("int")).cast("long").alias("n_any"))


@register("count_positive", sql=f"""
WITH {L_NULLED}
SELECT l_orderkey, CAST(sum(CAST(coalesce(disc_n > 0, false) AS INTEGER) + CAST(coalesce(l_tax > 0, false) AS INTEGER)
       + CAST(coalesce(l_quantity - 25 > 0, false) AS INTEGER)) AS BIGINT) AS n_pos
FROM L GROUP BY l_orderkey""")
def count_positive(spark, d):
    li = _lineitem_nulled(spark, d)
    return li.groupBy("l_orderkey").agg(
        F.sum(C.count_positive(["disc_n", "l_tax", F.col("l_quantity") - 25])).cast("long").alias("n_pos"))


# ---- P16: ratio / interaction features ----------------------------------------------

# Sums of 2-decimal values are rounded back to 2 places, so both engines continue
# from the same doubles whatever their summation order.
LSUM = """G AS (SELECT l_orderkey, round(sum(l_extendedprice), 2) AS price, round(sum(l_quantity), 2) AS qty,
  round(sum(l_discount), 2) AS disc, round(sum(l_tax), 2) AS tax FROM lineitem GROUP BY l_orderkey)"""


def _line_totals(spark, d):
    return tbl(spark, d, "lineitem").groupBy("l_orderkey").agg(
        *[F.round(F.sum(c), 2).alias(n) for c, n in [("l_extendedprice", "price"), ("l_quantity", "qty"),
                                                      ("l_discount", "disc"), ("l_tax", "tax")]])


@register("ratio_features", sql=f"""
WITH {LSUM}
SELECT l_orderkey, price / qty AS unit_price,
  tax / (disc + CAST(1e-6 AS DOUBLE)) AS tax_per_disc,
  CASE WHEN disc = 0 THEN NULL ELSE tax / disc END AS tax_disc_ratio
FROM G""")
def ratio_features(spark, d):
    g = _line_totals(spark, d)
    return g.select("l_orderkey", C.guarded_ratio("price", "qty").alias("unit_price"),
                    C.guarded_ratio("tax", "disc", eps=1e-6).alias("tax_per_disc"),
                    C.guarded_ratio("tax", "disc").alias("tax_disc_ratio"))


@register("interaction_features", sql=f"""
WITH {LSUM}
SELECT l_orderkey, disc * price AS disc_price, price * qty * (1 + tax) AS weighted,
  price - 100 * qty AS price_gap
FROM G""")
def interaction_features(spark, d):
    g = _line_totals(spark, d)
    return g.select("l_orderkey", (F.col("disc") * F.col("price")).alias("disc_price"),
                    (F.col("price") * F.col("qty") * (1 + F.col("tax"))).alias("weighted"),
                    (F.col("price") - 100 * F.col("qty")).alias("price_gap"))


# ---- P17: bit-packed flags -----------------------------------------------------------

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("bitpack_flags", sql="""
SELECT o_custkey, CAST(
  max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) * 1 +
  max(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END) * 2 +
  max(CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END) * 4 +
  max(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1 ELSE 0 END) * 8 +
  max(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) * 16 AS BIGINT) AS prio_code
FROM orders GROUP BY o_custkey""")
def bitpack_flags(spark, d):
    o = tbl(spark, d, "orders")
    has = o.groupBy("o_custkey").agg(*[F.max((F.col("o_orderpriority") == p).cast("int")).alias(f"h{i}")
                                       for i, p in enumerate(PRIORITIES)])
    return has.select("o_custkey", C.bitpack([f"h{i}" for i in range(len(PRIORITIES))]).alias("prio_code"))


# ---- P18: closed formula ---------------------------------------------------------------

@register("closed_formula", sql="""
SELECT p_partkey, round(p_retailprice * 0.3 + p_size * p_size / (1 + p_partkey % 10) - sqrt(p_size) * 1.5
                        + ln(1 + p_retailprice) / (p_size + 2), 6) AS score
FROM part""")
def closed_formula(spark, d):
    p = tbl(spark, d, "part")
    f = (F.col("p_retailprice") * 0.3 + F.col("p_size") * F.col("p_size") / (1 + F.col("p_partkey") % 10)
         - F.sqrt("p_size") * 1.5 + F.log1p("p_retailprice") / (F.col("p_size") + 2))
    return p.select("p_partkey", r(f).alias("score"))


# ---- P20: rule with fallback ---------------------------------------------------------

@register("rule_flag_fallback", sql=f"""
WITH {O_SQL}
SELECT o_orderkey, CASE WHEN price_n IS NOT NULL THEN CAST(price_n >= 200000 AS INTEGER)
  ELSE CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS INTEGER) END AS big
FROM O""")
def rule_flag_fallback(spark, d):
    o = O(spark, d)
    return o.select("o_orderkey", C.rule_flag_with_fallback(
        "price_n", 200000, F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("big"))


# ---- P21: known rows -------------------------------------------------------------------

@register("known_rows", sql=f"""
WITH {O_SQL}
SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n FROM O
WHERE price_n IS NOT NULL AND y_known <> -1 GROUP BY o_orderstatus""")
def known_rows(spark, d):
    o = O(spark, d).where(F.col("price_n").isNotNull() & (F.col("y_known") != -1))
    return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).cast("long").alias("n"))


# ---- A10: row statistics over an embedding -------------------------------------------

EMB_SQL = """E AS (SELECT vec_id, list_transform(embedding,
  lambda x: CASE WHEN CAST(x AS DOUBLE) < -0.2 THEN NULL ELSE CAST(x AS DOUBLE) END) AS v FROM embeddings),
E2 AS (SELECT vec_id, list_filter(v, lambda x: x IS NOT NULL) AS v FROM E)"""


@register("row_stats", sql=f"""
WITH {EMB_SQL}
SELECT vec_id, round(list_avg(v), 6) AS mean, round(list_stddev_samp(v), 6) AS std,
  round(list_min(v), 6) AS vmin, round(list_max(v), 6) AS vmax,
  round(list_max(v) - list_min(v), 6) AS vrange, round(list_sum(v), 6) AS vsum
FROM E2""")
def row_stats(spark, d):
    e = wide(spark, tbl(spark, d, "embeddings"))
    v = F.transform("embedding", lambda x: F.when(x.cast("double") >= -0.2, x.cast("double")))
    e = e.select("vec_id", v.alias("v"))
    return e.select("vec_id", r(C.row_mean("v")).alias("mean"), r(C.row_std("v")).alias("std"),
                    r(C.row_min("v")).alias("vmin"), r(C.row_max("v")).alias("vmax"),
                    r(C.row_range("v")).alias("vrange"), r(C.row_sum("v")).alias("vsum"))


# ---- N1-N4: math ---------------------------------------------------------------------

@register("log_transforms", sql="""
SELECT c_custkey, round(CASE WHEN c_acctbal > -1 THEN ln(1 + c_acctbal) END, 6) AS log1p_bal,
  round(CASE WHEN c_acctbal > 0 THEN ln(c_acctbal) END, 6) AS log_bal,
  round(exp(c_acctbal / 10000.0) - 1, 6) AS expm1_bal, round(exp(c_acctbal / 10000.0), 6) AS exp_bal
FROM customer""")
def log_transforms(spark, d):
    c = tbl(spark, d, "customer")
    return c.select("c_custkey", r(C.log1p("c_acctbal")).alias("log1p_bal"), r(C.ln("c_acctbal")).alias("log_bal"),
                    r(F.expm1(F.col("c_acctbal") / 10000.0)).alias("expm1_bal"),
                    r(F.exp(F.col("c_acctbal") / 10000.0)).alias("exp_bal"))


@register("power_transforms", sql="""
SELECT o_orderkey, round(o_totalprice * o_totalprice / 1e6, 4) AS sq, round(sqrt(o_totalprice), 6) AS root,
  round(pow(o_totalprice / 1000.0, 0.425), 6) AS pw
FROM orders""")
def power_transforms(spark, d):
    o = tbl(spark, d, "orders")
    return o.select("o_orderkey", r(F.col("o_totalprice") * F.col("o_totalprice") / 1e6, 4).alias("sq"),
                    r(F.sqrt("o_totalprice")).alias("root"),
                    r(F.pow(F.col("o_totalprice") / 1000.0, 0.425)).alias("pw"))


@register("round_half_even", sql="""
SELECT p_partkey, CAST(round_even(p_size / 2.0, 0) AS DOUBLE) AS half_size,
  CAST(round_even(CAST(p_retailprice AS DOUBLE) / 20.0, 0) AS DOUBLE) AS r20,
  CAST(trunc(p_retailprice / 7.0) AS BIGINT) AS trunc7
FROM part""")
def round_half_even(spark, d):
    p = tbl(spark, d, "part")
    return p.select("p_partkey", F.bround(F.col("p_size") / 2.0, 0).alias("half_size"),
                    F.bround(F.col("p_retailprice") / 20.0, 0).alias("r20"),
                    (F.col("p_retailprice") / 7.0).cast("long").alias("trunc7"))


# ---- B1-B7: binning --------------------------------------------------------------------

@register("bin_fixed_right", sql="""
SELECT c_custkey, CASE WHEN c_acctbal > -1000 AND c_acctbal <= 0 THEN 'Debt'
  WHEN c_acctbal > 0 AND c_acctbal <= 2500 THEN 'Low' WHEN c_acctbal > 2500 AND c_acctbal <= 5000 THEN 'Mid'
  WHEN c_acctbal > 5000 AND c_acctbal <= 10000 THEN 'High' END AS bal_bin
FROM customer""")
def bin_fixed_right(spark, d):
    c = tbl(spark, d, "customer")
    return c.select("c_custkey", B.cut_right("c_acctbal", [-1000, 0, 2500, 5000, 10000],
                                             ["Debt", "Low", "Mid", "High"]).alias("bal_bin"))


@register("bin_quantile", sql="""
WITH q AS (SELECT min(o_totalprice) q0, quantile_cont(o_totalprice, 0.25) q1, quantile_cont(o_totalprice, 0.5) q2,
                  quantile_cont(o_totalprice, 0.75) q3, max(o_totalprice) q4 FROM orders)
SELECT o_orderkey, CASE WHEN o_totalprice >= q0 AND o_totalprice <= q1 THEN 'Low'
  WHEN o_totalprice > q1 AND o_totalprice <= q2 THEN 'Medium' WHEN o_totalprice > q2 AND o_totalprice <= q3 THEN 'High'
  WHEN o_totalprice > q3 AND o_totalprice <= q4 THEN 'Very High' END AS price_bin
FROM orders CROSS JOIN q""")
def bin_quantile(spark, d):
    o = tbl(spark, d, "orders")
    edges = global_quantiles(o, "o_totalprice", [0.0, 0.25, 0.5, 0.75, 1.0])
    return o.select("o_orderkey", B.cut_right("o_totalprice", edges, ["Low", "Medium", "High", "Very High"],
                                              include_lowest=True).alias("price_bin"))


@register("bin_left_multiplier", sql="""
SELECT c_custkey, round(c_acctbal * CASE WHEN c_acctbal / 10000.0 >= 0.5 AND c_acctbal / 10000.0 < 0.6 THEN 1.2
  WHEN c_acctbal / 10000.0 >= 0.6 AND c_acctbal / 10000.0 < 0.7 THEN 1.375
  WHEN c_acctbal / 10000.0 >= 0.7 AND c_acctbal / 10000.0 < 0.8 THEN 1.55
  WHEN c_acctbal / 10000.0 >= 0.8 AND c_acctbal / 10000.0 < 0.9 THEN 1.725 ELSE 1.9 END, 6) AS scaled
FROM customer""")
def bin_left_multiplier(spark, d):
    c = tbl(spark, d, "customer")
    mult = B.band(F.col("c_acctbal") / 10000.0, [(0.5, 0.6, 1.2), (0.6, 0.7, 1.375), (0.7, 0.8, 1.55),
                                                 (0.8, 0.9, 1.725)], 1.9, closed="left")
    return c.select("c_custkey", r(F.col("c_acctbal") * mult, 6).alias("scaled"))


@register("bin_ordinal", sql="""
SELECT p_partkey, CASE WHEN p_size <= 20 THEN 1 WHEN p_size <= 30 THEN 2 WHEN p_size <= 40 THEN 3
  WHEN p_size <= 50 THEN 4 WHEN p_size <= 60 THEN 5 ELSE 6 END AS size_bin FROM part""")
def bin_ordinal(spark, d):
    p = tbl(spark, d, "part")
    return p.select("p_partkey", B.ladder("p_size", [20, 30, 40, 50, 60], [1, 2, 3, 4, 5], 6).alias("size_bin"))


@register("bin_distance", sql="""
SELECT o_orderkey, CASE WHEN o_totalprice / 200.0 <= 500 THEN 'very short'
  WHEN o_totalprice / 200.0 <= 1000 THEN 'short' WHEN o_totalprice / 200.0 <= 1500 THEN 'mid'
  WHEN o_totalprice / 200.0 <= 2000 THEN 'midlong' WHEN o_totalprice / 200.0 <= 2500 THEN 'long'
  ELSE 'very long' END AS dist_bin FROM orders""")
def bin_distance(spark, d):
    o = tbl(spark, d, "orders")
    return o.select("o_orderkey", B.ladder(F.col("o_totalprice") / 200.0, [500, 1000, 1500, 2000, 2500],
                                           ["very short", "short", "mid", "midlong", "long"], "very long")
                    .alias("dist_bin"))


HHMM_SQL = "(hour(ts) * 100 + minute(ts))"


@register("bin_clock", sql=f"""
SELECT event_id,
  CASE WHEN {HHMM_SQL} > 459 AND {HHMM_SQL} <= 1159 THEN 'Morning'
       WHEN {HHMM_SQL} > 1159 AND {HHMM_SQL} <= 1659 THEN 'Afternoon'
       WHEN {HHMM_SQL} > 1659 AND {HHMM_SQL} <= 2059 THEN 'Evening' ELSE 'Midnight' END AS time_type,
  CASE WHEN {HHMM_SQL} <= 600 THEN 'vem' WHEN {HHMM_SQL} <= 900 THEN 'm' WHEN {HHMM_SQL} <= 1200 THEN 'mm'
       WHEN {HHMM_SQL} <= 1500 THEN 'maf' WHEN {HHMM_SQL} <= 1800 THEN 'af' WHEN {HHMM_SQL} <= 2100 THEN 'n'
       WHEN {HHMM_SQL} <= 2400 THEN 'nn' ELSE 'lm' END AS time_bin
FROM events""")
def bin_clock(spark, d):
    e = tbl(spark, d, "events")
    t = F.hour("ts") * 100 + F.minute("ts")
    four = B.band(t, [(459, 1159, "Morning"), (1159, 1659, "Afternoon"), (1659, 2059, "Evening")], "Midnight")
    eight = B.ladder(t, [600, 900, 1200, 1500, 1800, 2100, 2400], ["vem", "m", "mm", "maf", "af", "n", "nn"], "lm")
    return e.select("event_id", four.alias("time_type"), eight.alias("time_bin"))


@register("bin_round_cap", sql="""
SELECT p_partkey, least(CAST(round_even(p_size / 20.0, 0) AS DOUBLE), 2.0) AS size_cap,
  greatest(p_size - 25, 0) AS size_over, abs(p_size - 25) AS size_dev FROM part""")
def bin_round_cap(spark, d):
    p = tbl(spark, d, "part")
    return p.select("p_partkey", B.round_cap("p_size", 20, 2).alias("size_cap"),
                    C.floor_at(F.col("p_size") - 25, 0).alias("size_over"),
                    F.abs(F.col("p_size") - 25).alias("size_dev"))


@register("season_of_month", sql="""
SELECT o_orderkey, CASE WHEN month(o_orderdate) = 12 OR month(o_orderdate) BETWEEN 1 AND 2 THEN 'Winter'
  WHEN month(o_orderdate) BETWEEN 3 AND 5 THEN 'Spring' WHEN month(o_orderdate) BETWEEN 6 AND 8 THEN 'Summer'
  ELSE 'Fall' END AS season, CAST(month(o_orderdate) = 12 AS INTEGER) AS year_end
FROM orders""")
def season_of_month(spark, d):
    o = tbl(spark, d, "orders")
    return o.select("o_orderkey", season(F.month("o_orderdate")).alias("season"),
                    (F.month("o_orderdate") == 12).cast("int").alias("year_end"))
