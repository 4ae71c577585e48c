"""Train and predict for a processed domain table (the model step of each domain).

Train rows are selected by the domain's rule; a key-hash hold-out of the train
rows is the validation part.  Two Spark ML models (gradient-boosted trees and
a random forest) are fitted on the rest with the same feature router; their
blend weight is swept on the validation part (accuracy, RMSLE or MAE), a
binary task may tune its decision threshold for F1, and the test rows get the
blended, inverse-transformed and post-adjusted prediction as ``(id, prediction)``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import models as M
from ..operators import validate as V


@dataclass
class ModelSpec:
    target: str
    id_col: str
    train_rule: Column
    task: str  # "binary" or "regression"
    numeric: Sequence[str]
    categorical: Sequence[str] = ()
    blend_metric: str = "accuracy"  # accuracy | rmsle | rmse | mae
    tune_threshold: bool = False
    output: str = "label"  # binary: "label", "probability" or "boolean"
    transform: Callable[[Column], Column] | None = None  # target transform before fitting
    inverse: Callable[[Column], Column] | None = None  # its inverse on predictions
    post_add: float = 0.0
    post_step_threshold: float | None = None
    post_step: float = 0.0
    holdout: float = 0.2
    max_iter: int = 20
    max_depth: int = 5
    num_trees: int = 50
    seed: int = 0
    #: numeric columns that the second model sees as their first ``pca_k`` principal components
    pca_columns: Sequence[str] = ()
    pca_k: int = 3
    #: one boosted model whose round and threshold are chosen together on a stratified hold-out
    staged: bool = False
    rounds: int = 100
    learning_rate: float = 0.1
    info: dict = field(default_factory=dict)


def _estimators(spec: ModelSpec):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.regression import RandomForestRegressor
    if spec.task == "binary":
        a = M.gbt_classifier("__label", max_iter=spec.max_iter, max_depth=spec.max_depth, seed=spec.seed)
        b = RandomForestClassifier(labelCol="__label", numTrees=spec.num_trees, maxDepth=spec.max_depth,
                                   seed=spec.seed)
    else:
        a = M.gbt_regressor("__label", max_iter=spec.max_iter, max_depth=spec.max_depth, seed=spec.seed)
        b = RandomForestRegressor(labelCol="__label", numTrees=spec.num_trees, maxDepth=spec.max_depth,
                                  seed=spec.seed)
    return a, b


def _scored(df: DataFrame, models: dict, task: str) -> DataFrame:
    """``df`` with one prediction column per model, without a join: each model
    writes under names of its own."""
    from pyspark.ml.functions import vector_to_array
    for name, model in models.items():
        model.setPredictionCol(f"{name}_label" if task == "binary" else name)
        if task == "binary":
            model.setProbabilityCol(f"{name}_vector").setRawPredictionCol(f"{name}_raw")
        df = model.transform(df)
        if task == "binary":
            df = df.withColumn(name, vector_to_array(f"{name}_vector")[1])
    return df


def train_predict(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """Fit, validate, blend and predict; returns ``(id, prediction)`` of the test rows.
    One fitted feature router serves both models, and both score the same rows in
    sequence, so rows with NULL or repeated ids stay.  Fitted choices (blend weight, threshold, validation metric) land in ``spec.info``."""
    from pyspark.ml import Pipeline
    label = F.col(spec.target).cast("double")
    if spec.staged:
        return _train_predict_staged(df, spec)
    if spec.transform is not None:
        label = spec.transform(label)
    data = df.withColumns({"__id": F.col(spec.id_col), "__label": label})
    train = data.where(spec.train_rule & F.col("__label").isNotNull())
    test = data.where(~spec.train_rule)
    is_val = V.holdout_flag(V.key_hash(F.col("__id"), spec.seed), spec.holdout) == 1
    fit_part, val_part = train.where(~is_val), train.where(is_val)

    router = Pipeline(stages=M.feature_assembler(list(spec.numeric), list(spec.categorical))).fit(fit_part)
    est_a, est_b = _estimators(spec)
    route = _with_components(spec, fit_part, router)
    if spec.pca_columns:
        est_b.setFeaturesCol("__features_b")
    ready = route(fit_part).select("__label", "features", *(["__features_b"] if spec.pca_columns else []))
    models = {"__pa": est_a.fit(ready), "__pb": est_b.fit(ready)}

    val = _scored(route(val_part), models, spec.task).select("__label", "__pa", "__pb")
    sweep = M.blend_sweep(val, "__label", "__pa", "__pb", spec.blend_metric)
    best = sweep.where(F.col("best") == 1).first()
    w = float(best["w"])
    spec.info.update(weight=w, validation_metric=float(best["metric"]))

    threshold = 0.5
    if spec.task == "binary" and spec.tune_threshold:
        grid = val.sparkSession.range(100, 901).select((F.col("id").cast("double") / 1000.0).alias("t"))
        blended = val.withColumn("__p", M.apply_blend("__pa", "__pb", w))
        tbest = M.mark_best(M.threshold_sweep(blended, "__label", "__p", grid), "f1", "threshold") \
            .where(F.col("best") == 1).first()
        threshold = float(tbest["threshold"])
        spec.info.update(threshold=threshold, f1=float(tbest["f1"]))

    scored = _scored(route(test), models, spec.task)
    p = M.apply_blend("__pa", "__pb", w)
    if spec.task == "binary":
        if spec.output == "probability":
            pred = p
        elif spec.output == "boolean":
            pred = p > F.lit(threshold)
        else:
            pred = M.apply_threshold(p, threshold)
    else:
        pred = spec.inverse(p) if spec.inverse is not None else p
        pred = M.post_adjust(pred, spec.post_add, spec.post_step_threshold, spec.post_step)
    return scored.select(F.col("__id").alias(spec.id_col), pred.alias(spec.target))


def _with_components(spec: ModelSpec, fit_part: DataFrame, router) -> Callable[[DataFrame], DataFrame]:
    """The feature router; with ``pca_columns`` also ``__features_b``, where the principal components
    of the mean-filled columns stand in their place (E10)."""
    if not spec.pca_columns:
        return router.transform
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler, VectorSizeHint
    from pyspark.ml.functions import array_to_vector

    from ..core import scalar_row
    from ..operators.encode import fit_pca
    columns = list(spec.pca_columns)
    means = scalar_row(fit_part.agg(*[F.avg(c).alias(c) for c in columns]))
    names = [f"__pca_{c}" for c in columns]

    def filled(df: DataFrame) -> DataFrame:
        return df.withColumns({n: F.coalesce(F.col(c).cast("double"), F.lit(means[c] or 0.0)) for n, c in zip(names, columns)})
    pca = fit_pca(filled(fit_part), names, spec.pca_k, "__pca")
    rest = [c for c in spec.numeric if c not in columns]
    others = Pipeline(stages=M.feature_assembler(rest, list(spec.categorical), "__rest", prefix="__b")).fit(fit_part)
    size = VectorSizeHint(inputCol="__pcs", size=len(pca.components), handleInvalid="optimistic")
    join = VectorAssembler(inputCols=["__pcs", "__rest"], outputCol="__features_b", handleInvalid="keep")
    spec.info.update(pca_variances=pca.variances)

    def route(df: DataFrame) -> DataFrame:
        with_pcs = pca.transform(filled(router.transform(df))).withColumn("__pcs", array_to_vector("__pca"))
        return join.transform(size.transform(others.transform(with_pcs)))
    return route


def _train_predict_staged(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """One boosted classifier; a stratified hold-out of the train rows chooses its round (early
    stopping) and its F1 threshold together, from one table over all rounds (M2, V2, M11)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    from ..operators import boosting as B
    data = df.withColumns({"__id": F.col(spec.id_col), "__label": F.col(spec.target).cast("double"),
                           "__h": V.key_hash(F.col(spec.id_col), spec.seed)})
    train = data.where(spec.train_rule & F.col("__label").isNotNull())
    train = V.stratified_holdout(train, "__label", "__h", "__id", spec.holdout, "__val")
    router = Pipeline(stages=M.feature_assembler(list(spec.numeric), list(spec.categorical))).fit(train.where("__val = 0"))
    ready = router.transform(train).select("__id", "__val", "__label", vector_to_array("features").alias("__x"))
    job = B.Job(B.Candidate(depth=spec.max_depth, learning_rate=spec.learning_rate))
    model = B.boost(ready.where("__val = 0"), "__x", "__label", [job], "__id", rounds=spec.rounds, seed=spec.seed).models[0]
    table = B.staged_thresholds(ready.where("__val = 1"), model, "__x", "__label", [t / 1000 for t in range(100, 901)])
    best = table.where("best = 1").first()
    rounds, threshold = (best["round"], best["threshold"]) if best else (len(model.trees), 0.5)
    spec.info.update(rounds=rounds, threshold=threshold, f1=best["f1"] if best else None, trees=len(model.trees))
    scored = router.transform(data.where(~spec.train_rule)).withColumn("__x", vector_to_array("features"))
    p = model.score("__x", rounds)
    pred = {"probability": p, "boolean": p > F.lit(threshold)}.get(spec.output, M.apply_threshold(p, threshold))
    return scored.select(F.col("__id").alias(spec.id_col), pred.alias(spec.target))


def feature_lists(df: DataFrame, exclude: Sequence[str]) -> tuple[list[str], list[str]]:
    """Numeric and text feature columns of a processed table."""
    from pyspark.sql import types as T
    skip = set(exclude)
    numeric = [f.name for f in df.schema.fields if f.name not in skip and isinstance(
        f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType))]
    text = [f.name for f in df.schema.fields if f.name not in skip and isinstance(f.dataType, T.StringType)]
    return numeric, text


def domain_spec(domain: str, df: DataFrame, **overrides) -> ModelSpec:
    """The model settings of each domain: target, id, train rule, task, blend
    metric, threshold tuning, target transform and post adjustment (M1-M15)."""
    c = F.col
    # Per-domain target, id, train rule and output settings.
    settings = {
        "titanic": dict(target="Survived", id_col="PassengerId", train_rule=c("PassengerId") <= 891,
                        task="binary", blend_metric="accuracy", pca_columns=("Sex", "Age", "SibSp", "Parch", "Fare")),
        "housing": dict(target="SalePrice", id_col="Id", train_rule=c("Id") <= 1460, task="regression",
                        blend_metric="rmse", transform=F.log1p, inverse=F.expm1, post_add=2700.0),
        "spaceship": dict(target="Transported", id_col="PassengerId", train_rule=c("Transported") != -1,
                          task="binary", blend_metric="accuracy", output="boolean"),
        "molecular": dict(target="T80", id_col="Batch_ID", train_rule=c("Batch_ID").contains("Train"),
                          task="regression", blend_metric="mae", post_add=-0.1),
        "russian_car": dict(target="price", id_col="id", train_rule=c("id") <= 51635, task="regression",
                            blend_metric="mae", inverse=F.expm1, post_add=-2450.0),
        "loan": dict(target="Credit Default", id_col="Id", train_rule=c("Id") <= 7499, task="binary",
                     staged=True, holdout=0.1),
        "math_exam": dict(target="mean_exam_points", id_col="Id", train_rule=c("Id") <= 9999, task="regression",
                          blend_metric="mae", post_step_threshold=40.0, post_step=-0.1),
        "delayed_flight": dict(target="dep_delayed_15min", id_col="id", train_rule=c("id") > 99999,
                               task="binary", blend_metric="accuracy", output="probability"),
        "calories": dict(target="Calories", id_col="id",
                         train_rule=(c("id") < 750000) | (c("id") > 5000000), task="regression",
                         blend_metric="rmse", inverse=F.expm1),
    }[domain]
    settings.update(overrides)
    numeric, text = feature_lists(df, [settings["target"], settings["id_col"]])
    settings.setdefault("numeric", numeric)
    settings.setdefault("categorical", text)
    if "pca_columns" in settings:  # those that the table holds as numbers
        settings["pca_columns"] = [x for x in settings["pca_columns"] if x in settings["numeric"]]
    return ModelSpec(**settings)
