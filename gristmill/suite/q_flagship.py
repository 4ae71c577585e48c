"""Flagship: the minimum end-to-end slice on orders x customer.

Group-median fill of the price by priority (I5/W5), ratio to the segment mean
(W2), quartile label (B2), and the train-only delay-rate encoding by nation
(A4 + J1).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..core import cut_lineage, materialize
from ..functions.binning import cut_right
from ..operators.groupstats import attach_stats
from ..operators.valuecounts import ValueCounts
from .inputs import OC, OC_SQL
from .registry import register

QUARTILE_LABELS = ["Low", "Medium", "High", "Very High"]


def order_features(df):
    """The flagship feature plan on an OC-shaped DataFrame.

    The joined columns are written once; one value-count table gives the medians and, with
    the filled values in their places, the quartiles."""
    df = cut_lineage(df.select("o_orderkey", "price_n", "o_orderpriority", "c_mktsegment", "c_nationkey", "y", "is_train"))
    counts = ValueCounts.fit(df, numbers=["price_n"], by=["o_orderpriority"])
    medians = materialize(counts.quantiles([0.5], ["__median"]).drop("n", "column"))
    edges = counts.filled(medians, "__median").quantiles([0.0, 0.25, 0.5, 0.75, 1.0], by=()).first()
    edges = [edges[f"q{i}"] for i in range(5)] if edges else [None] * 5
    df = medians.attach(df, ["o_orderpriority"]).withColumn("price_n", F.coalesce("price_n", "__median")).drop("__median")
    # segment mean (all rows) and nation delay rate (train rows): one scan
    df = attach_stats(df, [("c_mktsegment", "price_n", "mean", "__seg_mean", None),
                           ("c_nationkey", "y", "rate", "nation_rate", F.col("is_train"))])
    return df.select(
        "o_orderkey",
        F.round("price_n", 4).alias("price_f"),
        F.round(F.col("price_n") / F.col("__seg_mean"), 6).alias("price_ratio"),
        cut_right("price_n", edges, QUARTILE_LABELS, include_lowest=True).alias("price_bin"),
        F.round("nation_rate", 6).alias("nation_rate"))


@register("order_features", sql=f"""
WITH {OC_SQL},
med AS (SELECT o_orderpriority, median(price_n) AS m FROM OC GROUP BY 1),
F1 AS (SELECT OC.*, coalesce(price_n, med.m) AS price_f FROM OC JOIN med USING (o_orderpriority)),
seg AS (SELECT c_mktsegment, avg(price_f) AS a FROM F1 GROUP BY 1),
q AS (SELECT min(price_f) AS q0, quantile_cont(price_f, 0.25) AS q1, quantile_cont(price_f, 0.5) AS q2,
             quantile_cont(price_f, 0.75) AS q3, max(price_f) AS q4 FROM F1),
rate AS (SELECT c_nationkey, avg(CASE WHEN y = 1 THEN 1.0 ELSE 0.0 END) AS r FROM F1 WHERE is_train GROUP BY 1)
SELECT o_orderkey, round(price_f, 4) AS price_f, round(price_f / seg.a, 6) AS price_ratio,
  CASE WHEN price_f >= q0 AND price_f <= q1 THEN 'Low'
       WHEN price_f > q1 AND price_f <= q2 THEN 'Medium'
       WHEN price_f > q2 AND price_f <= q3 THEN 'High'
       WHEN price_f > q3 AND price_f <= q4 THEN 'Very High' END AS price_bin,
  round(rate.r, 6) AS nation_rate
FROM F1 JOIN seg USING (c_mktsegment) CROSS JOIN q LEFT JOIN rate USING (c_nationkey)
""")
def q_order_features(spark, d):
    return order_features(OC(spark, d))
