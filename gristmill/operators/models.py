"""Models, ensembling and decision rules.

Sweeps (blend weights, decision thresholds) are one pass over the data:
all candidates are evaluated inside a single aggregation, and the arg-best is
picked inside Spark -- nothing but the final small table reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..core import col_of
from .ranges import bucket_of


# ---- blend weight sweep (M7-M10) -------------------------------------------------------

def blend_sweep(df: DataFrame, label, pred_a, pred_b, metric: str = "accuracy", step: float = 0.01,
                cutoff: float = 0.5) -> DataFrame:
    """Evaluate ``w*a + (1-w)*b`` for w = 0, step, ..., 1 in one pass.

    Returns (w, metric, best, i); ``best`` marks the first weight reaching the best
    value (ties -> lowest weight, as a strict ``>`` sweep keeps).  Metrics: accuracy
    (``> cutoff``, maximised), rmsle, mae and rmse (minimised).  Rows with a NULL do
    not count.

    A row's blend is linear in w, so no row is evaluated per weight: its class, or the sign
    of its error, turns at one grid point at most.  Rows are summed per turning point (at
    most one group per weight), and running sums over the grid give every weight's accuracy
    or absolute error; the squared error is a quadratic with three sums.  Only the logarithmic
    error needs a term per weight.
    """
    n = int(round(1 / step)) + 1
    cols = df.select(col_of(label).cast("double").alias("y"), col_of(pred_a).cast("double").alias("a"),
                     col_of(pred_b).cast("double").alias("b")).where("y is not null and a is not null and b is not null")
    sweep = {"accuracy": _sweep_accuracy, "mae": _sweep_absolute, "rmse": _sweep_squared, "rmsle": _sweep_logarithmic}.get(metric)
    if sweep is None:
        raise ValueError(metric)
    values = sweep(cols, n, step, cutoff)
    known = [v for v in values if v is not None]
    best = (max if metric == "accuracy" else min)(known) if known else None
    first = next((i for i, v in enumerate(values) if v == best), -1) if known else -1
    rows = [(i * step, v, int(i == first), i) for i, v in enumerate(values)]
    return df.sparkSession.createDataFrame(rows, "w double, metric double, best int, i int")


def _turns(per: list, n: int, before, after) -> list[float]:
    """Per weight: ``before(row, i)`` of the groups that turn later, and ``after(row, i)`` of the others."""
    return [sum(before(r, i) if r["k"] > i else after(r, i) for r in per) for i in range(n)]


def _sweep_accuracy(cols: DataFrame, n: int, step: float, cutoff: float) -> list[float | None]:
    def chosen(i):
        w = i.cast("double") * F.lit(step)
        return w * F.col("a") + (F.lit(1.0) - w) * F.col("b") > cutoff
    ends = cols.withColumns({"p0": chosen(F.lit(0)), "p1": chosen(F.lit(n - 1))})
    # near the crossing the blend itself decides, as rounding may move it by a grid point
    crossing = F.floor(F.try_divide(F.lit(cutoff) - F.col("b"), (F.col("a") - F.col("b")) * F.lit(step)))
    at = ends.withColumn("g", F.greatest(F.lit(0), F.least(crossing - 1, F.lit(n - 1))).cast("int"))
    k = F.col("g")
    for d in range(4):
        i = F.col("g") + d
        k = k + ((i < n) & (chosen(i) == F.col("p0"))).cast("int")
    turn = F.when(F.col("p0") == F.col("p1"), F.lit(n)).otherwise(k)
    right = (F.col("p0").cast("double") == F.col("y")).cast("long"), ((~F.col("p0")).cast("double") == F.col("y")).cast("long")
    per = at.groupBy(turn.alias("k")).agg(F.count("*").alias("n"), F.sum(right[0]).alias("r0"), F.sum(right[1]).alias("r1")).collect()
    total = sum(r["n"] for r in per)
    return [x / total if total else None for x in _turns(per, n, lambda r, i: r["r0"], lambda r, i: r["r1"])]


def _sweep_absolute(cols: DataFrame, n: int, step: float, cutoff: float) -> list[float | None]:
    e = cols.select((F.col("b") - F.col("y")).alias("d"), (F.col("a") - F.col("b")).alias("s"), (F.col("a") - F.col("y")).alias("z"))
    up = (F.col("d") > 0) | ((F.col("d") == 0) & (F.col("z") > 0))
    crosses = F.col("d") * F.col("z") < 0
    k = F.when(crosses, F.floor(F.try_divide(-F.col("d"), F.col("s") * F.lit(step))) + 1).otherwise(F.lit(n)).cast("int")
    sign = F.when(up, F.lit(1.0)).otherwise(F.lit(-1.0))
    per = e.groupBy(k.alias("k")).agg(F.count("*").alias("n"), F.sum(sign * F.col("d")).alias("d"), F.sum(sign * F.col("s")).alias("s")).collect()
    total = sum(r["n"] for r in per)
    sums = _turns(per, n, lambda r, i: r["d"] + i * step * r["s"], lambda r, i: -(r["d"] + i * step * r["s"]))
    return [x / total if total else None for x in sums]


def _sweep_squared(cols: DataFrame, n: int, step: float, cutoff: float) -> list[float | None]:
    d, s = F.col("b") - F.col("y"), F.col("a") - F.col("b")
    r = cols.agg(F.count("*").alias("n"), F.sum(d * d).alias("dd"), F.sum(d * s).alias("ds"), F.sum(s * s).alias("ss")).first()
    if not r["n"]:
        return [None] * n
    return [math.sqrt(max(r["dd"] + 2 * i * step * r["ds"] + (i * step) ** 2 * r["ss"], 0.0) / r["n"]) for i in range(n)]


def _sweep_logarithmic(cols: DataFrame, n: int, step: float, cutoff: float) -> list[float | None]:
    def of(i: int) -> Column:
        w = F.lit(i) * F.lit(step)
        d = F.log1p(w * F.col("a") + (F.lit(1.0) - w) * F.col("b")) - F.log1p("y")
        return F.sqrt(F.avg(d * d))
    return list(cols.agg(F.array(*[of(i) for i in range(n)]).alias("m")).first()["m"])


def apply_blend(pred_a, pred_b, w: float) -> Column:
    return F.lit(w) * col_of(pred_a) + F.lit(1.0 - w) * col_of(pred_b)


# ---- decision threshold (M11, M12) -----------------------------------------------------

MAX_THRESHOLDS = 100_000


def threshold_sweep(df: DataFrame, label, score, thresholds: DataFrame) -> DataFrame:
    """tp, fp, fn, f1 of ``score > t`` for every threshold in ``thresholds(t)``.

    The thresholds are a grid of candidates (collected, ``MAX_THRESHOLDS`` at most;
    repeated ones are answered once).  Each score is bucketed by the number of
    thresholds below it, one aggregation counts classes per bucket, and running
    sums over the grid give every threshold's counts.
    """
    y, s = col_of(label), col_of(score).cast("double")
    rows = thresholds.select(F.col("t").cast("double").alias("t")).limit(MAX_THRESHOLDS + 1).collect()
    if len(rows) > MAX_THRESHOLDS:
        raise ValueError(f"more than {MAX_THRESHOLDS} thresholds")
    grid = sorted({float(r["t"]) for r in rows})
    per = (df.select(y.alias("__y"), bucket_of(s, grid, "double").alias("at"), s.alias("v")).where(F.col("v").isNotNull())
             .groupBy("at").agg(F.sum((F.col("__y") == 1).cast("long")).alias("pos"),
                                F.sum((F.col("__y") != 1).cast("long")).alias("neg")))
    at_grid = df.sparkSession.createDataFrame(list(enumerate([None, *grid])), "i int, threshold double")
    per = at_grid.join(per, F.col("i") == F.col("at"), "left")
    whole = Window.partitionBy(F.lit(0))  # one row per threshold
    above = whole.orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0)
    tp = F.coalesce(F.sum("pos").over(above), zero)
    fp = F.coalesce(F.sum("neg").over(above), zero)
    fn = F.coalesce(F.sum("pos").over(whole), zero) - tp
    out = per.select("threshold", tp.alias("tp"), fp.alias("fp"), fn.alias("fn")).where(F.col("threshold").isNotNull())
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    return out.withColumn("f1", F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0)))


def mark_best(df: DataFrame, metric: str, order: str, larger: bool = True) -> DataFrame:
    """Flag the arg-best row of a small candidate table (ties -> smallest ``order``)."""
    w = Window.partitionBy().orderBy(F.desc(metric) if larger else F.asc(metric), F.asc(order))
    return df.withColumn("best", (F.row_number().over(w) == 1).cast("int"))


def apply_threshold(score, t: float) -> Column:
    return (col_of(score) > F.lit(t)).cast("int")


# ---- post adjustment, target transforms (M13, M14) -------------------------------------

def post_adjust(pred, add: float = 0.0, step_threshold: float | None = None, step: float = 0.0) -> Column:
    """``pred + add``; with a threshold, ``+step`` above it and ``-step`` at or below."""
    p = col_of(pred) + F.lit(add)
    if step_threshold is not None:
        p = F.when(p > F.lit(step_threshold), p + F.lit(step)).otherwise(p - F.lit(step))
    return p


# ---- Spark ML models (M1-M6, M15) ------------------------------------------------------

def feature_assembler(numeric: Sequence[str], categorical: Sequence[str], output: str = "features",
                      scale: bool = True, categorical_fill: str | None = None, constant: str = "missing", prefix: str = "__"):
    """Column-type router (E9): impute + scale numerics, one-hot categoricals
    (unknown -> zeros), assemble one vector.  Returns a list of ML stages.

    ``categorical_fill``: None leaves a NULL category unknown, ``"most_frequent"``
    fills it with the fitted rows' mode, ``"constant"`` with ``constant``, which is a
    level of its own if fitted rows hold it.  ``prefix`` keeps two routers of one table apart."""
    from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
    from .scaling import CategoryFill, PopulationScaler
    stages = []
    num_in = list(numeric)
    if num_in:
        imp = [f"{prefix}imp_{c}" for c in num_in]
        stages.append(Imputer(inputCols=num_in, outputCols=imp, strategy="mean"))
        stages.append(VectorAssembler(inputCols=imp, outputCol=f"{prefix}num", handleInvalid="keep"))
        if scale:
            stages.append(PopulationScaler(f"{prefix}num", f"{prefix}nums"))
    cat_out = []
    if categorical:
        idx = [f"{prefix}idx_{c}" for c in categorical]
        cat_out = [f"{prefix}ohe_{c}" for c in categorical]
        source = list(categorical)
        if categorical_fill:
            source = [f"{prefix}cat_{c}" for c in categorical]
            stages.append(CategoryFill(list(categorical), source, categorical_fill, constant))
        # the indexer files unknown levels last and the encoder drops the last one: they become all zeros
        stages.append(StringIndexer(inputCols=source, outputCols=idx, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=cat_out, dropLast=True, handleInvalid="error"))
    parts = [f"{prefix}nums" if scale else f"{prefix}num"] if num_in else []
    stages.append(VectorAssembler(inputCols=parts + cat_out, outputCol=output, handleInvalid="keep"))
    return stages


def gbt_regressor(label: str, features: str = "features", max_iter: int = 20, step_size: float = 0.1,
                  max_depth: int = 5, subsample: float = 1.0, seed: int = 0, min_info_gain: float = 0.0):
    from pyspark.ml.regression import GBTRegressor
    return GBTRegressor(labelCol=label, featuresCol=features, maxIter=max_iter, stepSize=step_size,
                        maxDepth=max_depth, subsamplingRate=subsample, seed=seed, minInfoGain=min_info_gain)


def gbt_classifier(label: str, features: str = "features", max_iter: int = 20, step_size: float = 0.1,
                   max_depth: int = 5, subsample: float = 1.0, seed: int = 0,
                   validation_col: str | None = None):
    from pyspark.ml.classification import GBTClassifier
    kw = dict(labelCol=label, featuresCol=features, maxIter=max_iter, stepSize=step_size,
              maxDepth=max_depth, subsamplingRate=subsample, seed=seed)
    if validation_col:
        kw["validationIndicatorCol"] = validation_col
    return GBTClassifier(**kw)


def multiclass_classifier(label: str, features: str = "features", num_trees: int = 20, max_depth: int = 5,
                          seed: int = 0, prediction: str = "prediction"):
    from pyspark.ml.classification import RandomForestClassifier
    return RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=num_trees,
                                  maxDepth=max_depth, seed=seed, predictionCol=prediction,
                                  probabilityCol=prediction + "_prob", rawPredictionCol=prediction + "_raw")


def fit_apply(stages, train: DataFrame, test: DataFrame):
    """Pipeline fit on train, transform test."""
    from pyspark.ml import Pipeline
    model = Pipeline(stages=list(stages)).fit(train)
    return model, model.transform(test)


def two_stage_classify(train: DataFrame, test: DataFrame, label: str, group_map: Mapping[int, int],
                       features: str = "features", seed: int = 0, num_trees: int = 20) -> DataFrame:
    """Coarse group first, then a per-group classifier (M5).  A group with one
    class predicts it as a constant.  Returns test rows with ``prediction``."""
    coarse = F.create_map(*[x for k, v in group_map.items() for x in (F.lit(k), F.lit(v))])
    tr = train.withColumn("__g", F.element_at(coarse, F.col(label)).cast("double"))
    stage1 = multiclass_classifier("__g", features, num_trees, seed=seed, prediction="__pg").fit(tr)
    routed = stage1.transform(test).drop("__pg_prob", "__pg_raw")
    parts = []
    for g in sorted(set(group_map.values())):
        sub = tr.where(F.col("__g") == g)
        classes = [r[0] for r in sub.select(label).distinct().limit(2).collect()]
        rows = routed.where(F.col("__pg") == float(g))
        if len(classes) <= 1:
            const = float(classes[0]) if classes else float(g)
            parts.append(rows.withColumn("prediction", F.lit(const)))
        else:
            m = multiclass_classifier(label, features, num_trees, seed=seed).fit(sub)
            parts.append(m.transform(rows).drop("prediction_prob", "prediction_raw"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.drop("__pg")


def pseudo_label(train: DataFrame, test: DataFrame, label: str, make_estimator) -> DataFrame:
    """Predict the test part, append it to train as labelled rows, refit and
    predict again (M6)."""
    first = make_estimator().fit(train)
    guessed = first.transform(test).select(*test.columns, F.col("prediction").alias(label))
    both = train.select(*test.columns, F.col(label).cast("double").alias(label)).unionByName(
        guessed.withColumn(label, F.col(label).cast("double")))
    second = make_estimator().fit(both)
    return second.transform(test)
