"""Exact top-k search by norm-bucketed retrieval.

Candidates are grouped by length into buckets (quantiles of the norm); a bucket
with many rows is dealt into blocks, so that no block depends on how norms tie.
Queries come in blocks too; each pair of a query block and a candidate block is
one group, and a block of candidates is scanned in runs of falling length.  For
a run, a query's k-th best score so far and the run's greatest length give the
local cosine threshold: above 1 the query skips the run; if it is high, the run
is pruned by the feasible interval of the query's largest coordinates; else
only candidates long enough stay.  What is left is verified with its inner
product.  Scores to start from come from a first scan over the longest
vectors; queries that a bucket cannot improve are not sent to it.

Components are floor(scale * x); products of such integers are exact in
doubles below 2^53.

Edge cases: null vectors, vectors with a null or non-finite component, and rows
with a null id take no part; identical rows count once; an id with several
vectors is a query for each, and is no candidate of its own; vectors of
different dimension have no score; an empty vector scores 0; ties go to the
smaller id; fewer than k candidates give fewer rows; an empty table gives an
empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, ship_by_value

_RUN = 1024  # candidates that share a local threshold
_HIGH = 0.8  # local cosine threshold from which coordinates prune better than lengths
_FOCUS = 3  # largest query coordinates that are tested
_SLACK = 1e-9


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    v = F.transform(vector_col, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    fine = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return (vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & fine)
            .select(F.col(id_col).alias("id"), v.alias("v")).distinct()
            .withColumns({"dim": F.size("v"),
                          "norm": F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))}))


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best, ties to the smaller id."""
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= kth)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))


def search_block(q_ids, q, q_norm, floor, c_ids, c, c_norm, k: int):
    """For each query (scores below ``floor`` need not be found): ids and scores of its best k of the block."""
    order = np.lexsort((c_ids, -c_norm))
    c_ids, c, c_norm = c_ids[order], c[order], c_norm[order]
    found = [(np.zeros(0, np.int64), np.zeros(0)) for _ in q_ids]
    floor = floor.copy()
    for a in range(0, len(c_ids), _RUN):
        ids, run, norms = c_ids[a:a + _RUN], c[a:a + _RUN], c_norm[a:a + _RUN]
        local = (floor - _SLACK * (1 + np.abs(floor))) / np.maximum(q_norm * norms[0], 1e-300)
        local = np.where((q_norm == 0) | (norms[0] == 0), np.where(floor > 0, 2.0, -1.0), local)
        live = np.flatnonzero(local <= 1.0 + _SLACK)
        if not len(live):
            continue
        by_coordinate = live[local[live] >= _HIGH]
        by_length = live[local[live] < _HIGH]
        kept = []
        if len(by_length):
            products = q[by_length] @ run.T
            for i, row in zip(by_length, products):
                # lengths fall along the run, so the candidates that are long enough are a prefix
                enough = len(norms) if floor[i] <= 0 else np.searchsorted(-norms, -(floor[i] / q_norm[i]) * (1 - _SLACK), side="right")
                kept.append((i, np.arange(enough), row[:enough]))
        if len(by_coordinate):
            unit = run / np.maximum(norms, 1e-300)[:, None]
            for i in by_coordinate:
                t, u = min(local[i], 1.0), q[i] / q_norm[i]
                feasible = norms >= (floor[i] / q_norm[i]) * (1 - _SLACK)
                for f in np.argsort(-np.abs(u))[:_FOCUS]:
                    reach = np.sqrt(max(0.0, (1 - t * t) * (1 - u[f] * u[f]))) + 1e-7
                    # within the threshold's angle of the axis itself, the interval reaches its end
                    if u[f] < t:
                        feasible &= unit[:, f] <= u[f] * t + reach
                    if u[f] > -t:
                        feasible &= unit[:, f] >= u[f] * t - reach
                at = np.flatnonzero(feasible)
                kept.append((i, at, run[at] @ q[i]))
        for i, at, scores in kept:
            good = (scores >= floor[i]) & (ids[at] != q_ids[i])
            if good.any():
                all_ids = np.concatenate([found[i][0], ids[at][good]])
                all_scores = np.concatenate([found[i][1], scores[good]])
                best = _best(all_ids, all_scores, k)
                found[i] = all_ids[best], all_scores[best]
                if len(best) == k:
                    floor[i] = max(floor[i], found[i][1][-1])
    return found


def _arrays(rows: pd.DataFrame):
    return (rows["id"].to_numpy(np.int64), np.array(rows["v"].tolist(), np.float64).reshape(len(rows), -1),
            rows["norm"].to_numpy(np.float64))


def top_k(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: float = 64.0, buckets: int = 16, block_rows: int = 8192, query_rows: int = 4096) -> DataFrame:
    """(query_id, rank, id, score): the k highest inner products of every row for
    which ``queries`` (a condition on column ``id``) holds, against all other rows."""
    scratch = Scratch(vectors.sparkSession, "topk")
    rows = scratch.table(integer_vectors(vectors, id_col, vector_col, scale), "vectors")
    asked = rows.where(queries).withColumn("q_key", F.xxhash64("v"))

    # The _RUN longest vectors, a bounded block: the k-th best score among them is a lower bound.
    head = rows.orderBy(F.desc("norm"), "id").limit(_RUN).toPandas()
    heads = {int(d): _arrays(g) for d, g in head.groupby("dim")}

    def floors(batches):
        for batch in batches:
            batch = batch.assign(floor=-np.inf)
            for d, at in batch.groupby("dim").groups.items():
                if int(d) in heads:
                    q_ids, q, q_norm = _arrays(batch.loc[at])
                    first = search_block(q_ids, q, q_norm, np.full(len(q_ids), -np.inf), *heads[int(d)], k)
                    batch.loc[at, "floor"] = [s[-1] if len(s) == k else -np.inf for _, s in first]
            yield batch

    asked = scratch.table(asked.mapInPandas(floors, "id long, v array<long>, dim int, norm double, q_key long, floor double"),
                          "queries")
    shares = [i / buckets for i in range(1, buckets)]
    edges = sorted(set(rows.approxQuantile("norm", shares, 0.001) if rows.head(1) else []))
    bucket = F.lit(0)
    for e in edges:
        bucket = bucket + (F.col("norm") < F.lit(e)).cast("int")
    rows = rows.withColumn("bucket", bucket)
    stats = scratch.table(rows.groupBy("dim", "bucket").agg(
        F.ceil(F.count("*") / F.lit(float(block_rows))).cast("int").alias("blocks"), F.max("norm").alias("longest")), "buckets")
    n_query_blocks = max(1, -(-asked.count() // query_rows))

    dealt = (rows.join(stats.select("dim", "bucket", "blocks"), ["dim", "bucket"])
             .withColumn("block", F.pmod(F.xxhash64("id", "v"), F.col("blocks")).cast("int"))
             .withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(n_query_blocks - 1)))))
    sent = (asked.join(stats, "dim")
            .where(F.col("norm") * F.col("longest") * (1 + _SLACK) >= F.col("floor") * (1 - _SLACK))
            .withColumn("q_block", F.pmod(F.xxhash64("q_key", "id"), F.lit(n_query_blocks)).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    group = ["dim", "bucket", "block", "q_block"]

    def scan(candidates: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(candidates) and len(asking):
            found = search_block(*_arrays(asking), asking["floor"].to_numpy(np.float64), *_arrays(candidates), k)
            for q_id, q_key, (ids, scores) in zip(asking["id"], asking["q_key"], found):
                out.append(pd.DataFrame({"query_id": q_id, "q_key": q_key, "id": ids, "score": scores.astype(np.int64)}))
        if not out:
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "q_key", "id", "score")})
        return pd.concat(out, ignore_index=True)

    found = (dealt.select(*group, "id", "v", "norm").groupBy(*group)
             .cogroup(sent.select(*group, "id", "v", "norm", "q_key", "floor").groupBy(*group))
             .applyInPandas(scan, "query_id long, q_key long, id long, score long"))
    w = Window.partitionBy("query_id", "q_key").orderBy(F.desc("score"), "id")
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))


def op4_exact_topk(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(vectors, F.col("id") % 20 == 0, 20)


OP4_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

ship_by_value(__name__)
