"""Shared derived inputs (same definition on the Spark and the SQL side).

O   = orders + price_n (NULL where key % 7 = 0), prio_n (NULL where key % 11 = 0),
      y (status F), is_train (key % 5 <> 0), y_known (y on train rows, else -1)
OC  = O joined to its customer;  OCN = OC + nation + region
S   = O + two scores p1, p2 in [0, 1)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.io import read_table, spread


def T(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_table(spark, d, name)


def wide(spark: SparkSession, df: DataFrame, partitions: int | None = None) -> DataFrame:
    """The small scales' tables are one unsplittable file each: deal a scan of fewer tasks than
    ``partitions`` (the cores by default) out before heavy work on texts and arrays."""
    partitions = partitions or spark.sparkContext.defaultParallelism
    return spread(df, partitions) if df.rdd.getNumPartitions() < partitions else df


def O(spark, d) -> DataFrame:
    o = T(spark, d, "orders")
    k = F.col("o_orderkey")
    y = F.when(F.col("o_orderstatus") == "F", F.lit(1)).otherwise(F.lit(0))
    is_train = (k % 5) != 0
    return o.withColumns({
        "price_n": F.when(k % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice")),
        "prio_n": F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")),
        "y": y,
        "is_train": is_train,
        "y_known": F.when(is_train, y).otherwise(F.lit(-1)),
    })


def OC(spark, d) -> DataFrame:
    # customer is the dimension side; the planner broadcasts it while it is
    # small and falls back to a shuffle join when it is not.
    c = T(spark, d, "customer")
    return O(spark, d).join(c, F.col("o_custkey") == F.col("c_custkey"), "inner")


def OCN(spark, d) -> DataFrame:
    n = T(spark, d, "nation")
    r = T(spark, d, "region")
    return (OC(spark, d).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
                        .join(r, F.col("n_regionkey") == F.col("r_regionkey")))


def S(spark, d) -> DataFrame:
    k = F.col("o_orderkey")
    return O(spark, d).withColumns({"p1": ((k * 37) % 1000) / F.lit(1000.0),
                                    "p2": ((k * 91) % 1000) / F.lit(1000.0)})


O_SQL = """O AS (
  SELECT *,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price_n,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS prio_n,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
    (o_orderkey % 5 <> 0) AS is_train,
    CASE WHEN o_orderkey % 5 <> 0 THEN (CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) ELSE -1 END AS y_known
  FROM orders)"""

OC_SQL = O_SQL + """,
OC AS (SELECT * FROM O JOIN customer ON o_custkey = c_custkey)"""

OCN_SQL = OC_SQL + """,
OCN AS (SELECT * FROM OC JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

S_SQL = O_SQL + """,
S AS (SELECT *, CAST((o_orderkey * 37) % 1000 AS DOUBLE) / 1000.0 AS p1,
            CAST((o_orderkey * 91) % 1000 AS DOUBLE) / 1000.0 AS p2 FROM O)"""
