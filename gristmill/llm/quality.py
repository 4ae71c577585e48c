"""Quality classifier: histogram gradient-boosted trees over document statistics.

``statistics`` turns a whole text into a fixed vector of counts and ratios
(characters by kind, words, lines, repetition).  ``fit`` trains boosted
trees on a bounded sample of labelled rows, on the driver: features are binned
at the sample's quantiles, every level of a tree is grown for all its nodes at
once from gradient histograms.  The trees are complete and flattened into three
arrays (feature, threshold, leaf value); scoring walks all rows through all
trees together, one numpy step per level, inside Spark tasks.

The training sample is the ``max_labels`` labelled rows outside fold 0 with the
smallest hash of the id (documented bound, 20,000); scoring covers every row.
Id, language and source are never inputs.

Edge cases: null and empty texts have an all-zero vector and get a score like
any other; null labels are left out; several labels of an id count as one, by
majority; repeated rows get equal scores; without any label the score is the
prior 0.5; an empty table gives an empty result; other columns pass through, and input columns
named ``score`` or ``predicted`` are replaced.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_by_value

_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
    "stop": b".", "comma": b",", "bang": b"!", "query": b"?", "bar": b"|", "hash": b"#", "star": b"*", "money": b"$",
    "percent": b"%", "amp": b"&", "bracket": b"()[]{}<>", "quote": b"\"'`", "slash": b"/\\", "other": b"@^_~=+-:;",
    "space": b" \t\r\x0b\x0c", "line": b"\n",
}
_KIND_INDEX = [np.frombuffer(chars, np.uint8).astype(np.intp) for chars in _KINDS.values()]
STATISTICS = ["log_bytes", *(f"share_{k}" for k in _KINDS), "share_wide", "entropy", "log_words", "mean_word", "max_word",
              "sd_word", "distinct_words", "distinct_pairs", "top_word", "same_next", "upper_words", "log_lines",
              "distinct_lines", "mean_line", "stopped_lines", "short_lines"]


def statistics(text: bytes | None) -> list[float]:
    if not text:
        return [0.0] * len(STATISTICS)
    n = len(text)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    shares = counts / n
    used = shares[shares > 0]
    out = [np.log1p(n), *(float(shares[i].sum()) for i in _KIND_INDEX), float(shares[128:].sum()),
           float(-(used * np.log2(used)).sum())]
    words = text.split()
    if words:
        m = len(words)
        sizes = np.fromiter(map(len, words), np.int64, m)
        top = Counter(words).most_common(1)[0][1]
        pairs = list(zip(words, words[1:]))
        same = sum(a == b for a, b in pairs)
        out += [np.log1p(m), sizes.mean(), sizes.max(), sizes.std(), len(set(words)) / m,
                len(set(pairs)) / max(1, len(pairs)), top / m, same / m, sum(map(bytes.isupper, words)) / m]
    else:
        out += [0.0] * 9
    lines = text.split(b"\n")
    k = len(lines)
    out += [np.log1p(k), len(set(lines)) / k, n / k, sum(x.endswith(b".") for x in lines) / k,
            sum(len(x) < 40 for x in lines) / k]
    return out


def matrix(texts) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(len(texts), len(STATISTICS))


@dataclass
class Trees:
    """Complete trees of one depth: node i's children are 2i + 1 and 2i + 2."""

    prior: float
    feature: np.ndarray  # (trees, 2^depth - 1)
    threshold: np.ndarray  # (trees, 2^depth - 1); go right if x > threshold
    leaf: np.ndarray  # (trees, 2^depth)

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.prior)
        trees, nodes = self.feature.shape
        if trees and len(x):
            depth = int(nodes + 1).bit_length() - 1
            rows = np.arange(len(x))[:, None]
            tree = np.arange(trees)[None, :]
            at = np.zeros((len(x), trees), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, self.feature[tree, at]] > self.threshold[tree, at])
            margin = margin + self.leaf[tree, at - nodes].sum(axis=1)
        return 1.0 / (1.0 + np.exp(-margin))


def fit(x: np.ndarray, y: np.ndarray, n_trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
        ridge: float = 1.0, least: float = 2.0) -> Trees:
    """Boosted trees for the log-odds of ``y``; ``least`` is a leaf's least Hessian sum."""
    empty = Trees(0.0, np.zeros((0, 2 ** depth - 1), np.int64), np.zeros((0, 2 ** depth - 1)), np.zeros((0, 2 ** depth)))
    if not len(y):
        return empty
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    empty.prior = float(np.log(share / (1 - share)))
    if y.min() == y.max():
        return empty
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(m)], axis=1)  # x <= edge[b] iff bin <= b
    can_split = np.array([[b < len(edges[j]) for b in range(bins)] for j in range(m)])
    flat = binned + np.arange(m) * bins
    margin = np.full(n, empty.prior)
    features, thresholds, leaves = [], [], []
    for _ in range(n_trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        feature, threshold = np.zeros(2 ** depth - 1, np.int64), np.full(2 ** depth - 1, np.inf)
        node = np.zeros(n, np.int64)  # within the level
        for level in range(depth):
            width = 2 ** level
            cell = (node[:, None] * (m * bins) + flat).ravel()
            size = width * m * bins
            hist = [np.bincount(cell, np.repeat(v, m), size).reshape(width, m, bins).cumsum(axis=2) for v in (g, h)]
            (gl, hl), (gt, ht) = hist, (hist[0][:, :, -1:], hist[1][:, :, -1:])
            gain = gl ** 2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt ** 2 / (ht + ridge)
            gain = np.where(can_split & (hl >= least) & (ht - hl >= least), gain, 0.0).reshape(width, -1)
            best = gain.argmax(axis=1)
            split = gain[np.arange(width), best] > 1e-6
            f, b = best // bins, best % bins
            first = width - 1
            for i in np.flatnonzero(split):
                feature[first + i], threshold[first + i] = f[i], edges[f[i]][b[i]]
            right = split[node] & (binned[np.arange(n), f[node]] > b[node])
            node = 2 * node + right
        gs, hs = (np.bincount(node, v, 2 ** depth) for v in (g, h))
        leaf = -rate * gs / (hs + ridge)
        margin += leaf[node]
        features.append(feature), thresholds.append(threshold), leaves.append(leaf)
    return Trees(empty.prior, np.array(features), np.array(thresholds), np.array(leaves))


def fold_of(id_col: str) -> Column:
    """crc32 of the id as text, mod 5."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
          max_labels: int = 20_000, held_out_fold: int | None = 0, **options) -> Trees:
    """Fit on at most ``max_labels`` labelled rows, none of them in the held-out fold."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if held_out_fold is not None:
        known = known.where(fold_of(id_col) != held_out_fold)
    known = (known.groupBy(F.col(id_col).alias("_id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("_y"))
             .orderBy(F.xxhash64("_id"), "_id").limit(max_labels))

    @F.pandas_udf("array<double>")
    def statistics_of(texts: pd.Series) -> pd.Series:
        return pd.Series(list(matrix(texts)), dtype=object)

    # The labels are bounded by max_labels rows of two numbers, so they are broadcast.
    rows = (docs.select(F.col(id_col).alias("of"), F.col(text_col).cast("binary").alias("text"))
            .join(F.broadcast(known), F.col("of") == F.col("_id"))
            .select("_id", "_y", statistics_of("text").alias("x"))
            .groupBy("_id").agg(F.min(F.struct("_y", "x")).alias("r"))  # one row per id
            .select("_id", "r._y", "r.x").toPandas().sort_values("_id"))
    x = np.array(rows["x"].tolist(), np.float64).reshape(len(rows), len(STATISTICS))
    return fit(x, rows["_y"].to_numpy(np.float64), **options)


def score_column(trees: Trees, text_col: str = "text") -> Column:
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        out = [trees.score(matrix(texts.iloc[i:i + 2048])) for i in range(0, len(texts), 2048)]
        return pd.Series(np.concatenate(out) if out else [], dtype="float64")
    return score(F.col(text_col).cast("binary"))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = 0.3, **options) -> DataFrame:
    """``docs`` plus ``score`` and ``predicted`` (1 if the score reaches the threshold);
    columns of these names are replaced."""
    trees = train(docs, labels, id_col=id_col, text_col=text_col, **options)
    return (docs.withColumn("score", score_column(trees, text_col))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def op3_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return score_documents(docs, labels).select("doc_id", (fold_of("doc_id") == 0).alias("held_out"), "score", "predicted")


ship_by_value(__name__)
