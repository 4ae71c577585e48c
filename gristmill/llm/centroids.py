"""Centroid clustering of integer vectors, by expressions that stay in the JVM.

Method: vectors become arrays of integers, written once.  In a round every vector is
compared with a literal array of centroid arrays: ``zip_with`` and ``aggregate`` give the
squared distance, ``array_min`` over structs (distance, number) the nearest centroid
(ties: the smaller number).  One aggregation with a sum column per component (partial
sums on the map side, generated code) returns one row per cluster, and the centroids
move to the exact floor of the mean.  Only ``k`` x components numbers reach the driver,
whatever the number of vectors; a cluster that holds most rows is combined before the
shuffle.  Each round's plan is a scan of the written vectors and literals, so a
lost executor repeats one scan and no lineage builds up.

Edge cases: vectors that are null, of another length, or that hold a null or non-finite
component take no part; repeated rows count each; rows of one id are told apart by
their components where the starting order is tied; a null id sorts last among the
starting centroids, is clustered and returned; fewer vectors than ``k`` give as many
centroids; no vector gives an empty result; a component or distance beyond a long raises
Spark's overflow error instead of wrapping round; other columns are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

VECTOR = "array<bigint>"


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, size: int, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of every whole, finite vector with ``size`` components."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (rows.select(F.col(id_col).alias("id"), x.alias("x"), finite.alias("finite"))
            .where((F.size("x") == size) & F.col("finite"))
            .select("id", F.transform("x", lambda c: F.floor(c * F.lit(float(scale))).cast("bigint")).alias("v")))


def _literal(centroids: list[list[int]]) -> Column:
    """A literal array of centroid arrays."""
    return F.expr("array(" + ", ".join("array(" + ", ".join(f"bigint('{c}')" for c in row) + ")" for row in centroids) + ")")


def nearest(vector: Column, centroids: list[list[int]]) -> Column:
    """Struct (distance, cluster) of the nearest centroid, the smaller number among equals."""
    def distance(c: Column) -> Column:
        return F.aggregate(F.zip_with(vector, c, lambda a, b: (a - b) * (a - b)), F.lit(0).cast("bigint"), lambda s, d: s + d)
    return F.array_min(F.transform(_literal(centroids), lambda c, k: F.struct(distance(c).alias("distance"), k.alias("cluster"))))


def _assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    best = nearest(F.col("v"), centroids)
    return vectors.withColumn("best", best).select("id", "v", F.col("best.cluster").alias("cluster"),
                                                   F.col("best.distance").alias("distance"))


def _moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round; a cluster without vectors keeps its centroid."""
    dims = range(len(centroids[0]))
    sums = (_assigned(vectors, centroids).select("cluster", *[F.get("v", F.lit(i)).alias(f"c{i}") for i in dims])
            .groupBy("cluster").agg(F.count("*").alias("n"), *[F.sum(f"c{i}").alias(f"c{i}") for i in dims]))
    out = list(centroids)
    for r in sums.collect():  # at most one row per centroid
        out[r["cluster"]] = [r[f"c{i}"] // r["n"] for i in dims]
    return out


def centroid_clusters(rows: DataFrame, k: int, rounds: int, size: int, scale: int, seed: int = 2,
                      id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per vector that takes part."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "centroids")
    vectors = scratch.table(integer_vectors(rows, id_col, vector_col, size, scale), "vectors")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    start = vectors.select(order.alias("o"), "v").orderBy(F.col("o").asc_nulls_last(), "v").limit(k).collect()
    centroids = [list(r["v"]) for r in start] or [[0] * size]
    for _ in range(rounds if start else 0):
        centroids = _moved(vectors, centroids)
    assigned = scratch.table(_assigned(vectors, centroids).drop("v"), "assigned")
    inertia = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    of = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("cluster"))
    return assigned.select(F.col("id").alias(id_col), "cluster", "distance",
                           of([inertia.get(i, 0) for i in range(len(centroids))]).cast("bigint").alias("cluster_inertia"),
                           F.lit(sum(inertia.values())).cast("bigint").alias("inertia"), of(digests).alias("centroid_sha256"))


def op12_centroids(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return centroid_clusters(rows, k=40, rounds=5, size=64, scale=256)


def _sql(k: int, rounds: int, size: int, scale: int, seed: int) -> str:
    """The rounds unrolled into CTEs over (id, component, value) rows."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""d{r} AS MATERIALIZED (
  SELECT vec_id, k, CAST(sum((x - c) * (x - c)) AS BIGINT) AS distance FROM e JOIN c{r} USING (i) GROUP BY vec_id, k
), a{r} AS MATERIALIZED (
  SELECT vec_id, k, distance FROM d{r} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, k) = 1
)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT k, i, coalesce(m.c, o.c) AS c
  FROM c{r} o LEFT JOIN (
    SELECT k, i, CAST((sum(x) - (((sum(x) % count(*)) + count(*)) % count(*))) // count(*) AS BIGINT) AS c
    FROM e JOIN a{r} USING (vec_id) GROUP BY k, i) m USING (k, i)
)""")
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS xs FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}
), e AS MATERIALIZED (
  SELECT vec_id, generate_subscripts(xs, 1) AS i, CAST(floor({scale} * unnest(xs)) AS BIGINT) AS x FROM v
), s AS (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS k FROM v QUALIFY k < {k}
), c0 AS MATERIALIZED (SELECT k, i, x AS c FROM e JOIN s USING (vec_id)),
{", ".join(steps)},
h AS (SELECT k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN h USING (k)
"""


OP12_SQL = _sql(k=40, rounds=5, size=64, scale=256, seed=2)
