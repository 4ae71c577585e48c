"""Connected components of a link table, by alternating star contraction.

Every round joins neighbour minima back to the links; a written table cuts the
lineage.  Both join sides are plain scans, so adaptive execution can split the
partition of a hub.  The loop ends when a round changes no link.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _pairs(df: DataFrame) -> DataFrame:
    return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _minima(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``links`` (u, v) with m, the smallest of u and its neighbours."""
    low = links.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("u2"), F.least("u", "m").alias("m"))
    low = scratch.table(low, name)
    return links.join(low, F.col("u") == F.col("u2"))


def _large_star(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Every larger neighbour of u moves to the smallest node around u."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    return _pairs(_minima(both, scratch, f"{name}-low").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")))


def _small_star(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """u and its smaller neighbours move to the smallest of them."""
    down = _minima(links.select(F.col("a").alias("u"), F.col("b").alias("v")), scratch, f"{name}-low")
    moved = down.select(F.explode(F.array("u", "v")).alias("a"), F.col("m").alias("b"))
    return _pairs(moved)


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b of one comparable
    type); root is the smallest node of the component."""
    links = scratch.table(_pairs(links), "links")
    state = None
    step = 0
    while True:
        seen = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if seen == state or seen["n"] == 0:
            break
        state = seen
        step += 1
        links = scratch.table(_large_star(links, scratch, f"large{step}"), f"large{step}")
        links = scratch.table(_small_star(links, scratch, f"small{step}"), f"small{step}")
    leaves = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return leaves.unionByName(roots).groupBy("node").agg(F.min("root").alias("root"))
