"""The train-and-predict step: hold-out, two models, blend sweep, threshold,
target transform and post adjustment."""

import random

from pyspark.sql import functions as F

from gristmill.plans import titanic
from gristmill.plans.modeling import ModelSpec, domain_spec, train_predict
from gristmill.suite.inputs import OC

from conftest import SF_SMALL


def _oc(spark):
    return OC(spark, SF_SMALL).select(
        "o_orderkey", "is_train", "o_orderpriority", "c_mktsegment", "c_acctbal",
        F.month("o_orderdate").cast("double").alias("o_month"), F.year("o_orderdate").cast("double").alias("o_year"),
        ((F.col("c_acctbal") > 4500) | (F.col("o_orderpriority") == "1-URGENT")).cast("int").alias("label_cls"),
        (F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01")) + 1.0).alias("label_reg"))


def test_binary_with_threshold(spark):
    df = _oc(spark)
    spec = ModelSpec(target="label_cls", id_col="o_orderkey", train_rule=F.col("is_train"), task="binary",
                     numeric=["c_acctbal", "o_month"], categorical=["o_orderpriority", "c_mktsegment"],
                     tune_threshold=True, max_iter=3, max_depth=3, num_trees=5)
    out = train_predict(df, spec)
    rows = out.collect()
    assert len(rows) == df.where(~F.col("is_train")).count()
    assert {r.label_cls for r in rows} <= {0, 1}
    assert 0.0 <= spec.info["weight"] <= 1.0 and 0.1 <= spec.info["threshold"] <= 0.9
    truth = {r.o_orderkey: r.label_cls for r in df.where(~F.col("is_train")).collect()}
    acc = sum(truth[r.o_orderkey] == r.label_cls for r in rows) / len(rows)
    assert acc > 0.8


def test_regression_with_transform_and_post_adjust(spark):
    df = _oc(spark)
    spec = ModelSpec(target="label_reg", id_col="o_orderkey", train_rule=F.col("is_train"), task="regression",
                     numeric=["o_year", "o_month"], blend_metric="rmse", transform=F.log1p, inverse=F.expm1,
                     post_add=5.0, max_iter=3, max_depth=4, num_trees=5)
    out = train_predict(df, spec).join(df.select("o_orderkey", F.col("label_reg").alias("truth")), "o_orderkey")
    err = out.select(F.avg(F.abs(F.col("label_reg") - F.col("truth"))).alias("mae")).first().mae
    spread = df.select(F.stddev("label_reg")).first()[0]
    assert err < 0.5 * spread


def test_titanic_domain_model(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(1, 121):
        sex = rnd.choice(["male", "female"])
        title = "Mr" if sex == "male" else rnd.choice(["Mrs", "Miss"])
        rows.append((i, int(sex == "female") if i <= 90 else None, rnd.choice([1, 2, 3]), f"X, {title}. Y", sex,
                     None if rnd.random() < 0.2 else float(rnd.randint(1, 70)), rnd.randint(0, 2), rnd.randint(0, 2),
                     f"T {i}", float(rnd.randint(5, 80)), rnd.choice([None, "C85", "B2 B4"]), rnd.choice("SCQ")))
    df = spark.createDataFrame(rows, "PassengerId long, Survived int, Pclass int, Name string, Sex string, "
                                     "Age double, SibSp int, Parch int, Ticket string, Fare double, Cabin string, "
                                     "Embarked string")
    processed = titanic.preprocess(df)
    spec = domain_spec("titanic", processed, train_rule=F.col("PassengerId") <= 90, max_iter=3, num_trees=5,
                       categorical=["Embarked", "Title", "CabinLet"])
    out = train_predict(processed, spec)
    assert out.count() == 30 and out.columns == ["PassengerId", "Survived"]
    assert len(spec.info["pca_variances"]) == 3 and spec.info["pca_variances"] == sorted(spec.info["pca_variances"], reverse=True)


def test_staged_training_chooses_round_and_threshold(spark):
    df = _oc(spark)
    spec = ModelSpec(target="label_cls", id_col="o_orderkey", train_rule=F.col("is_train"), task="binary", holdout=0.1,
                     numeric=["c_acctbal", "o_month"], categorical=["o_orderpriority"], staged=True, rounds=12, max_depth=3,
                     learning_rate=0.4)
    rows = train_predict(df, spec).collect()
    truth = {r.o_orderkey: r.label_cls for r in df.where(~F.col("is_train")).collect()}
    assert len(rows) == len(truth)
    assert 1 <= spec.info["rounds"] <= spec.info["trees"] == 12 and 0.1 <= spec.info["threshold"] <= 0.9
    assert spec.info["f1"] > 0.9
    assert sum(truth[r.o_orderkey] == r.label_cls for r in rows) / len(rows) > 0.9


def test_router_has_no_dead_columns_and_fills_categories(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    from gristmill.operators import models as M
    fit = spark.createDataFrame([(1.0, "a", "x"), (3.0, "a", "y"), (None, "b", "x"), (2.0, None, "it's\\")], "n double, c string, d string")
    new = spark.createDataFrame([(2.0, "a", "x"), (None, None, "new"), (2.0, "b", None)], "n double, c string, d string")

    def vectors(**kw):
        model = Pipeline(stages=M.feature_assembler(["n"], ["c", "d"], scale=False, **kw)).fit(fit)
        return [r["v"] for r in model.transform(new).select(vector_to_array("features").alias("v")).collect()]
    plain = vectors()
    assert [len(v) for v in plain] == [1 + 2 + 3] * 3
    assert plain == [[2.0, 1.0, 0.0, 1.0, 0.0, 0.0], [2.0, 0.0, 0.0, 0.0, 0.0, 0.0], [2.0, 0.0, 1.0, 0.0, 0.0, 0.0]]
    frequent = vectors(categorical_fill="most_frequent")
    assert frequent[1][1:3] == [1.0, 0.0] and frequent[2][3] == 1.0 and len(frequent[0]) == 6
    constant = vectors(categorical_fill="constant")
    assert len(constant[0]) == 1 + 3 + 3 and constant[1][1:4] == [0.0, 0.0, 1.0]  # "missing" is a level of c only
