"""Mutual-information feature scoring (F1, F2) and score-based selection.

The contingency table is built by unpivoting every feature into
(feature, value, target) and one ``groupBy().count()`` -- a single scan and a
map-side-combined shuffle, whatever the number of features.  The table has
one row per (feature, level, class), so it is small for categorical data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..core import StatsTable, materialize
from .ranges import bucket_of
from .valuecounts import ValueCounts

NULL_LEVEL = "__null__"


def _long_form(df: DataFrame, features: Sequence[str], target: str, cast: str = "string") -> DataFrame:
    pairs = ", ".join(f"'{f}', `{f}`" for f in features)
    casted = df.select(*[F.col(f"`{f}`").cast(cast).alias(f) for f in features], F.col(f"`{target}`").alias("__y"))
    return casted.selectExpr(f"stack({len(features)}, {pairs}) as (feature, value)", "__y")


def mi_from_counts(joint: DataFrame, bias_correct: bool = False) -> DataFrame:
    """(feature, x, y, n) counts -> (feature, mi) with natural logarithms.

    Level totals are a window over (feature, level) -- at most one row per class in each window -- while the
    class totals and feature totals (one row per feature and class) are small
    aggregates joined by broadcast.  A high-cardinality feature is thus never
    gathered into one task."""
    from pyspark.sql import Window

    ny = materialize(joint.groupBy("feature", "y").agg(F.sum("n").alias("__ny")))
    # feature totals from the (already computed) class totals: one row per feature
    tot = StatsTable(ny.df.groupBy("feature").agg(F.sum("__ny").alias("__tot")), ny.small)
    j = joint.withColumn("__nx", F.sum("n").over(Window.partitionBy("feature", "x")))
    j = tot.attach(ny.attach(j, ["feature", "y"], "inner"), ["feature"], "inner")
    n, total = F.col("n"), F.col("__tot")
    term = n / total * F.log(n * total / (F.col("__nx") * F.col("__ny")))
    mi = j.groupBy("feature").agg(F.sum(term).alias("mi"), F.first("__tot").alias("__tot"),
                                  F.countDistinct("x").alias("__rx"), F.countDistinct("y").alias("__ry"))
    if bias_correct:
        corr = (F.col("__rx") - 1) * (F.col("__ry") - 1) / (2.0 * F.col("__tot"))
        mi = mi.withColumn("mi", F.greatest(F.col("mi") - corr, F.lit(0.0)))
    return mi.select("feature", "mi")


def mi_discrete(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Exact plug-in MI of each discrete feature with a discrete target (F1).
    NULL is its own level; rows with NULL target are skipped."""
    long = _long_form(df.where(F.col(target).isNotNull()), features, target)
    joint = (long.withColumn("x", F.coalesce(F.col("value"), F.lit(NULL_LEVEL)))
                 .groupBy("feature", "x", F.col("__y").alias("y")).agg(F.count(F.lit(1)).alias("n")))
    return mi_from_counts(joint)


def mi_binned(df: DataFrame, features: Sequence[str], target: str, bins: int = 10,
              target_bins: int | None = None) -> DataFrame:
    """MI for continuous features (F2): exact quantile bins (missing values and NaN are a bin of
    their own), then the plug-in estimate minus its (r-1)(c-1)/2N bias, clamped at 0.  A
    continuous target is binned the same way when ``target_bins`` is given."""
    src = df.where(F.col(target).isNotNull())
    if target_bins:
        from .quantile import global_quantiles
        edges = global_quantiles(src, target, [i / target_bins for i in range(1, target_bins)])
        yb = F.aggregate(F.array(*[F.lit(e) for e in edges]), F.lit(0),
                         lambda acc, e: acc + F.when(F.col(target) > e, 1).otherwise(0))
        src = src.withColumn("__ybin", yb)
        target = "__ybin"
    # one scan: values are counted per (feature, value, class); edges and bins come from the counts
    counts = ValueCounts.fit(src.withColumn("__y", F.col(f"`{target}`")), numbers=features, by=["__y"])
    edges = counts.quantiles([i / bins for i in range(1, bins)], [f"e{i}" for i in range(1, bins)], by=())
    edges = {r["column"]: [r[f"e{i}"] for i in range(1, bins)] for r in edges.collect()}
    x = F.lit(-1)  # missing
    for f in features:
        number = bucket_of(F.col("v"), sorted(set(edges.get(f, []))), "double")
        x = F.when((F.col("column") == f) & F.col("v").isNotNull(), number).otherwise(x)
    joint = (counts.table.groupBy(F.col("column").alias("feature"), x.alias("x"), F.col("__y").alias("y"))
             .agg(F.sum("n").alias("n")))
    return mi_from_counts(joint, bias_correct=True)


def select_by_score(df: DataFrame, scores: DataFrame, threshold: float,
                    keep: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Keep the columns whose score is > ``threshold`` plus ``keep``.
    The score table has one row per column of the schema, so it is collected."""
    chosen = {r["feature"] for r in scores.where(F.col("mi") > threshold).select("feature").collect()}
    cols = [c for c in df.columns if c in chosen or c in keep]
    return df.select(*[F.col(f"`{c}`") for c in cols]), cols


def ranked_scores(scores: DataFrame) -> DataFrame:
    """Scores sorted descending, ties by name (O1); the (Feature, MI Score) table."""
    return scores.orderBy(F.desc("mi"), F.asc("feature"))
