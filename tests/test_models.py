"""Rows-only model operators: better than a constant predictor, and the same
seed gives the same result."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from gristmill.operators import models as M
from gristmill.operators import validate as V
from gristmill.operators.cluster import cluster_with_distances
from gristmill.operators.text import TfidfLong, tfidf_vector_pipeline
from gristmill.suite.inputs import OC

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def data(spark):
    oc = OC(spark, SF_SMALL).withColumns({
        "o_year": F.year("o_orderdate").cast("double"), "o_month": F.month("o_orderdate").cast("double"),
        # the synthetic order status carries no signal; use a learnable label
        "label_cls": ((F.col("c_acctbal") > 4500) | F.col("o_orderpriority").isin("1-URGENT")).cast("double"),
        "label_reg": F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01")).cast("double")})
    return oc


def _stages():
    return M.feature_assembler(["o_year", "o_month", "c_acctbal"], ["o_orderpriority", "c_mktsegment"])


def test_gbt_classifier_beats_constant_and_repeats(spark, data):
    train, test = data.where(F.col("is_train")), data.where(~F.col("is_train"))
    _, p1 = M.fit_apply(_stages() + [M.gbt_classifier("label_cls", max_iter=5, max_depth=3, seed=7)], train, test)
    auc = BinaryClassificationEvaluator(labelCol="label_cls").evaluate(p1)
    assert auc > 0.7  # a constant score has AUC 0.5
    _, p2 = M.fit_apply(_stages() + [M.gbt_classifier("label_cls", max_iter=5, max_depth=3, seed=7)], train, test)
    a = {r.o_orderkey: r.prediction for r in p1.select("o_orderkey", "prediction").collect()}
    b = {r.o_orderkey: r.prediction for r in p2.select("o_orderkey", "prediction").collect()}
    assert a == b


def test_gbt_regressor_beats_mean(spark, data):
    train, test = data.where(F.col("is_train")), data.where(~F.col("is_train"))
    _, pred = M.fit_apply(_stages() + [M.gbt_regressor("label_reg", max_iter=5, max_depth=3)], train, test)
    rmse = RegressionEvaluator(labelCol="label_reg", metricName="rmse").evaluate(pred)
    mean = train.agg(F.avg("label_reg")).first()[0]
    const = test.select(F.sqrt(F.avg((F.col("label_reg") - mean) ** 2))).first()[0]
    assert rmse < 0.5 * const


def test_threshold_sweep_on_model_scores(spark, data):
    from pyspark.ml.functions import vector_to_array
    train, test = data.where(F.col("is_train")), data.where(~F.col("is_train"))
    _, pred = M.fit_apply(_stages() + [M.gbt_classifier("label_cls", max_iter=3, max_depth=3)], train, test)
    scored = pred.select("label_cls", vector_to_array("probability")[1].alias("p"))
    grid = spark.range(100, 901, 10).select((F.col("id") / 1000.0).alias("t"))
    best = M.mark_best(M.threshold_sweep(scored, "label_cls", "p", grid), "f1", "threshold") \
        .where("best = 1").first()
    assert 0.1 <= best.threshold <= 0.9 and best.f1 > 0.5
    assert V.roc_auc(scored, "label_cls", "p") > 0.7


def test_cluster_restarts_keep_lowest_cost(spark, data):
    one = cluster_with_distances(data, ["c_acctbal", "o_totalprice"], k=4, restarts=1, seed=3)
    three = cluster_with_distances(data, ["c_acctbal", "o_totalprice"], k=4, restarts=3, seed=3)
    assert {"Cluster", "Centroid0", "Centroid3"} <= set(three.columns)
    # distance to the own centre is the smallest distance of the row
    cols = [f"Centroid{i}" for i in range(4)]
    row = three.select("Cluster", *cols).first()
    assert row[f"Centroid{row.Cluster}"] == min(row[c] for c in cols)
    assert one.count() == three.count() == data.count()


def test_tfidf_vector_is_unit_norm(spark):
    b = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    model = tfidf_vector_pipeline("text", "tfidf", 200).fit(b)
    norms = [float(r.tfidf.norm(2)) for r in model.transform(b).select("tfidf").collect() if r.tfidf.numNonzeros()]
    assert norms and all(abs(n - 1.0) < 1e-9 for n in norms)
    long = TfidfLong("item_id", "text", 200).fit(b).transform(b)
    sq = long.groupBy("item_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("s")).collect()
    assert all(abs(r.s - 1.0) < 1e-9 for r in sq)


def test_learning_queries_do_the_full_work(spark, monkeypatch):
    import inspect
    from types import SimpleNamespace

    from gristmill.operators import boosting as B
    from gristmill.plans import housing, spaceship
    from gristmill.suite import QUERIES, q_learn
    for plan in (housing, spaceship):
        assert inspect.signature(plan.preprocess).parameters["restarts"].default == 50

    asked = {}

    class Asked(Exception):
        pass

    def clusters(*args, **kw):
        asked["restarts"] = inspect.signature(kmeans_label).bind(*args, **kw).arguments.get("restarts", 50)
        raise Asked
    kmeans_label = q_learn.kmeans_label
    monkeypatch.setattr(q_learn, "kmeans_label", clusters)
    with pytest.raises(Asked):
        QUERIES["kmeans_label"](spark, SF_SMALL)
    assert asked["restarts"] == 50

    def trained(df, features, label, jobs, key, fold=None, rounds=100, loss="logistic", **kw):
        asked.setdefault("jobs", []).extend(jobs)
        asked["rounds"] = rounds
        return B.Boosted([B.Booster(j, loss, 0.0, []) for j in jobs], [[(1.0, 1.0, 0.5)] * rounds for _ in jobs])
    monkeypatch.setattr(B, "boost", trained)
    for name, rows, models in (("grid_search", 144, 432 + 1), ("cv_score", 1, 3), ("random_search", 20, 60 + 1)):
        asked.clear()
        assert QUERIES[name](spark, SF_SMALL).count() == rows
        assert len(asked["jobs"]) == models and asked["rounds"] == 100
    assert len({c for c in q_learn.SEARCH_GRID}) == 144

    def fitted(kind):
        def make(*args, **kw):
            bound = inspect.signature(kind).bind(*args, **kw)
            bound.apply_defaults()
            asked.update(bound.arguments)
            raise Asked
        return make
    for name, kind, setting in (("fit_gbt_regressor", "gbt_regressor", "max_iter"), ("fit_gbt_classifier", "gbt_classifier", "max_iter"),
                                ("fit_multiclass", "multiclass_classifier", "num_trees"), ("two_stage_classify", "multiclass_classifier", "num_trees"),
                                ("pseudo_label", "multiclass_classifier", "num_trees")):
        asked.clear()
        with monkeypatch.context() as m:
            m.setattr(q_learn.M, kind, fitted(getattr(q_learn.M, kind)))
            with pytest.raises(Asked):
                QUERIES[name](spark, SF_SMALL)
        assert asked[setting] == 20 and asked["max_depth"] == 5
