"""Splits, folds and metrics (V1-V9).

Splits are functions of a row key (a hash), so they are stable when the data
is re-partitioned or a task is re-run -- ``randomSplit`` is not.  Metrics are
single aggregations; AUC uses exact mid-ranks from running totals over the
distinct scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..core import col_of, scalar_row
from .groupstats import ordinal_index, running_totals

HASH_BUCKETS = 1_000_000


def key_hash(key, seed: int = 42, buckets: int = HASH_BUCKETS) -> Column:
    """Deterministic bucket in [0, buckets) from a row key."""
    return F.pmod(F.xxhash64(col_of(key), F.lit(seed)), F.lit(buckets))


def holdout_flag(hash_col, fraction: float, buckets: int = HASH_BUCKETS) -> Column:
    """1 for the test part: ``hash < fraction * buckets`` (V1)."""
    return (col_of(hash_col) < F.lit(fraction * buckets)).cast("int")


def stratified_holdout(df: DataFrame, label: str, hash_col: str, key: str, fraction: float,
                       name: str = "is_test") -> DataFrame:
    """Per class, the ``ceil(fraction * n_class)`` rows with the smallest
    (hash, key) form the test part (V2).  Exact per-class sizes, no single
    partition sort."""
    ranked = ordinal_index(df, [hash_col, key], [label], "__rk", with_count=True)
    return ranked.withColumn(name, (F.col("__rk") < F.ceil(F.col("__rk_n") * F.lit(fraction))).cast("int")) \
                 .drop("__rk", "__rk_n")


def contiguous_folds(df: DataFrame, order: str, k: int, name: str = "fold") -> DataFrame:
    """Unshuffled k-fold: rows in ``order`` cut into k contiguous blocks, the
    first ``n % k`` one row larger (V3)."""
    idx = ordinal_index(df, [order], (), "__i", with_count=True)
    i, n = F.col("__i"), F.col("__i_n")
    q, r = F.floor(n / F.lit(k)), n % F.lit(k)
    big = r * (q + 1)
    fold = F.when(i < big, F.floor(i / (q + 1))).otherwise(r + F.floor((i - big) / F.greatest(q, F.lit(1))))
    return idx.withColumn(name, fold.cast("int")).drop("__i", "__i_n")


def hashed_folds(hash_col, k: int) -> Column:
    """Shuffled k-fold by key hash (V3)."""
    return F.pmod(col_of(hash_col), F.lit(k)).cast("int")


def classification_metrics(df: DataFrame, label, pred, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn, accuracy, precision, recall, f1 (V4); empty ratios -> 0."""
    y, p = col_of(label), col_of(pred)
    agg = df.groupBy(*by).agg(
        F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"),
        F.sum(((y != 1) & (p == 1)).cast("long")).alias("fp"),
        F.sum(((y == 1) & (p != 1)).cast("long")).alias("fn"),
        F.sum(((y != 1) & (p != 1)).cast("long")).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return agg.select(*by, "tp", "fp", "fn", "tn",
                      (((tp + tn) / (tp + fp + fn + tn))).alias("accuracy"),
                      F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
                      F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)).alias("recall"),
                      F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0)).alias("f1"))


def roc_auc_table(df: DataFrame, label, score) -> DataFrame:
    """Exact ROC-AUC with ties counted half (Mann-Whitney, V5) as a one-row
    DataFrame ``auc``: per distinct score the positive/negative counts (one
    aggregation), running negatives below each score, one final sum."""
    per = (df.select(col_of(label).alias("__y"), col_of(score).cast("double").alias("__s"))
             .where(F.col("__s").isNotNull() & F.col("__y").isNotNull())
             .groupBy("__s").agg(F.sum((F.col("__y") == 1).cast("double")).alias("pos"),
                                 F.sum((F.col("__y") != 1).cast("double")).alias("neg")))
    cum = running_totals(per, ["__s"], ["neg"], prefix="below_", inclusive=False)
    tot = cum.agg(F.sum(F.col("pos") * (F.col("below_neg") + 0.5 * F.col("neg"))).alias("num"),
                  F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return tot.select(F.try_divide(F.col("num"), F.col("P") * F.col("N")).alias("auc"))


def roc_auc(df: DataFrame, label, score) -> float | None:
    return scalar_row(roc_auc_table(df, label, score))["auc"]


def regression_metrics(df: DataFrame, label, pred, by: Sequence[str] = ()) -> DataFrame:
    """MAE, MSE, RMSE, R2, RMSLE, MAE of logs (V6) in one aggregation."""
    y, p = col_of(label).cast("double"), col_of(pred).cast("double")
    d = p - y
    ld = F.log1p(p) - F.log1p(y)
    agg = df.groupBy(*by).agg(F.avg(F.abs(d)).alias("mae"), F.avg(d * d).alias("mse"),
                              F.sum(d * d).alias("__sse"), F.var_pop(y).alias("__vy"),
                              F.count(F.lit(1)).alias("__n"),
                              F.avg(ld * ld).alias("__msle"), F.avg(F.abs(ld)).alias("mae_log"))
    return agg.select(*by, "mae", "mse", F.sqrt("mse").alias("rmse"),
                      (F.lit(1.0) - F.col("__sse") / (F.col("__vy") * F.col("__n"))).alias("r2"),
                      F.sqrt("__msle").alias("rmsle"), "mae_log")


def smape(df: DataFrame, label, pred, transform=None, eps: float = 1e-8) -> Column:
    """SMAPE in percent on (optionally transformed) values (V7), as an agg column."""
    y, p = col_of(label), col_of(pred)
    if transform is not None:
        y, p = transform(y), transform(p)
    return F.avg(F.lit(2.0) * F.abs(p - y) / (F.abs(y) + F.abs(p) + F.lit(eps))) * F.lit(100.0)


def cross_validate(estimator, evaluator, df: DataFrame, fold_col: str, param_maps=None,
                   parallelism: int = 2):
    """k-fold CV over a fold column (V3, V8): Spark's ``CrossValidator`` with
    ``foldCol``; every fold fit is a distributed job, candidates run in parallel."""
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    grid = param_maps if param_maps is not None else ParamGridBuilder().build()
    n_folds = df.select(fold_col).distinct().count()
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator,
                        numFolds=n_folds, foldCol=fold_col, parallelism=parallelism)
    return cv.fit(df.withColumn(fold_col, F.col(fold_col).cast("int")))


def random_search(estimator, evaluator, df: DataFrame, fold_col: str, space: dict, trials: int = 5,
                  seed: int = 0, refine: int = 15, parallelism: int = 2):
    """Seeded random search in continuous bounds (V9), then one narrowing round of
    ``refine`` trials around the best candidate.  ``space`` maps a Param to
    (low, high, kind)."""
    import random
    rnd = random.Random(seed)

    def draw(bounds, count):
        maps = []
        for _ in range(count):
            pm = {}
            for param, (lo, hi, kind) in bounds.items():
                v = rnd.uniform(lo, hi)
                pm[param] = int(round(v)) if kind == "int" else v
            maps.append(pm)
        return maps

    maps = draw(space, trials)
    model = cross_validate(estimator, evaluator, df, fold_col, maps, parallelism)
    scores = list(model.avgMetrics)
    best_i = max(range(len(scores)), key=lambda i: scores[i]) if evaluator.isLargerBetter() else \
        min(range(len(scores)), key=lambda i: scores[i])
    if refine:
        best = maps[best_i]
        narrow = {}
        for param, (lo, hi, kind) in space.items():
            half = (hi - lo) / 4
            narrow[param] = (max(lo, best[param] - half), min(hi, best[param] + half), kind)
        maps2 = draw(narrow, refine)
        model2 = cross_validate(estimator, evaluator, df, fold_col, maps2, parallelism)
        maps, scores = maps + maps2, scores + list(model2.avgMetrics)
        better = (lambda a, b: a > b) if evaluator.isLargerBetter() else (lambda a, b: a < b)
        if better(max(model2.avgMetrics) if evaluator.isLargerBetter() else min(model2.avgMetrics),
                  scores[best_i]):
            model = model2
    return model, list(zip(maps, scores))


def stratified_folds(df: DataFrame, order: str, label: str, k: int, name: str = "fold") -> DataFrame:
    """Unshuffled stratified k-fold (V3, classifier form), for any number of classes.

    The labels sorted by class are dealt round-robin into k folds: fold ``f``
    receives, of class ``c``, as many rows as there are positions ``p`` with
    ``p % k == f`` in the class's block ``[start_c, start_c + n_c)`` of the
    sorted labels.  The class's rows, in their original order, fill fold 0
    first, then fold 1, ...  Class starts come from running totals over the
    class counts, ranks from the skew-safe ordinal index; rows with a NULL label
    get a NULL fold."""
    classes = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("__class")).agg(F.count(F.lit(1)).alias("__n"))
    starts = running_totals(classes, ["__class"], ["__n"], prefix="__start", inclusive=False)
    starts = starts.select("__class", "__n", F.col("__start__n").cast("long").alias("__s"))

    def dealt(x, f):  # positions p in [0, x) with p % k == f
        return F.when(x <= f, F.lit(0).cast("long")).otherwise(F.floor((x - 1 - f) / F.lit(k)) + 1)

    rows_of = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda f: dealt(F.col("__s") + F.col("__n"), f) - dealt(F.col("__s"), f))
    starts = starts.withColumn("__rows", rows_of).drop("__s", "__n")
    ranked = ordinal_index(df, [order], [label], "__r").join(starts, F.col(label) == F.col("__class"), "left")
    # folds whose rows all come before this one
    full = F.aggregate("__rows", F.struct(F.col("__r").cast("long").alias("left"), F.lit(0).alias("fold")),
                       lambda a, n: F.struct((a["left"] - n).alias("left"),
                                             (a["fold"] + F.when(a["left"] >= n, 1).otherwise(0)).alias("fold")))
    return ranked.withColumn(name, full["fold"].cast("int")).drop("__r", "__rows", "__class")
