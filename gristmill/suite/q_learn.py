"""Feature scoring, clustering, splits, metrics, sweeps and model queries
(F1-F4, P7, E9, E10, V1-V9, M1-M15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..core import cut_lineage
from ..operators import boosting as B
from ..operators import models as M
from ..operators import score as SC
from ..operators import validate as V
from ..operators.cluster import kmeans_label, vector_distances
from ..operators.encode import fit_pca, pca_project
from ..session import ensure_checkpoint_dir
from .inputs import OC, OC_SQL, S, S_SQL, T as tbl
from .registry import register


def r(c, n=6):
    return F.round(F.col(c) if isinstance(c, str) else c, n)


# ---- F1, F2, P7, O1 --------------------------------------------------------------------

MI_FEATURES = ["prio_n", "c_mktsegment", "c_nationkey", "o_orderpriority"]


def _mi_sql_long(features, value_expr) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{f}' AS feature, {value_expr.format(f=f)} AS x, y FROM OC" for f in features)


def _mi_sql(long_cte: str, bias: bool, rounded: bool = True) -> str:
    corr = ("greatest(sum(n / tot * ln(n * tot / (nx * ny))) - (any_value(rx) - 1) * (any_value(ry) - 1) "
            "/ (2.0 * any_value(tot)), 0.0)") if bias else "sum(n / tot * ln(n * tot / (nx * ny)))"
    return f"""WITH {OC_SQL},
{long_cte},
J AS (SELECT feature, x, y, count(*) AS n FROM L GROUP BY ALL),
NX AS (SELECT feature, x, sum(n) AS nx FROM J GROUP BY ALL),
NY AS (SELECT feature, y, sum(n) AS ny FROM J GROUP BY ALL),
TT AS (SELECT feature, sum(n) AS tot, count(DISTINCT x) AS rx, count(DISTINCT y) AS ry FROM J GROUP BY feature)
SELECT feature, {"round(" + corr + ", 6)" if rounded else corr} AS mi
FROM J JOIN NX USING (feature, x) JOIN NY USING (feature, y) JOIN TT USING (feature) GROUP BY feature"""


_MI_DISCRETE_SQL = _mi_sql("L AS (" + _mi_sql_long(
    MI_FEATURES, "coalesce(CAST({f} AS VARCHAR), '__null__')") + ")", bias=False)


@register("mi_discrete", sql=_MI_DISCRETE_SQL)
def mi_discrete(spark, d):
    mi = SC.mi_discrete(OC(spark, d), MI_FEATURES, "y")
    return SC.ranked_scores(mi).select("feature", r("mi").alias("mi"))


MI_NUMERIC = ["o_totalprice", "c_acctbal"]
_EDGES = "[" + ", ".join(str(i / 10) for i in range(1, 10)) + "]"


@register("mi_binned", sql=_mi_sql(
    "R AS (" + _mi_sql_long(MI_NUMERIC, "CAST({f} AS DOUBLE)") + "),\n"
    f"E AS (SELECT feature, quantile_cont(x, {_EDGES}) AS edges FROM R GROUP BY feature),\n"
    "L AS (SELECT feature, CAST(len(list_filter(edges, lambda e: x > e)) AS VARCHAR) AS x, y "
    "FROM R JOIN E USING (feature))", bias=True))
def mi_binned(spark, d):
    mi = SC.mi_binned(OC(spark, d), MI_NUMERIC, "y", bins=10)
    return mi.select("feature", r("mi").alias("mi"))


@register("select_by_mi", sql="SELECT feature AS column_name FROM (" + _mi_sql("L AS (" + _mi_sql_long(
    MI_FEATURES, "coalesce(CAST({f} AS VARCHAR), '__null__')") + ")", bias=False, rounded=False)
    + ") WHERE mi > 0.0001 UNION ALL SELECT 'o_orderkey' UNION ALL SELECT 'y'")
def select_by_mi(spark, d):
    oc = OC(spark, d)
    mi = SC.mi_discrete(oc, MI_FEATURES, "y")
    _, columns = SC.select_by_score(oc, mi, 0.0001, keep=["o_orderkey", "y"])
    return spark.createDataFrame([(c,) for c in columns], "column_name string")


# ---- F3, F4, E10 -----------------------------------------------------------------------

N_DIMS = 64


@register("kmeans_label")
def q_kmeans_label(spark, d):
    """Every row's cluster, from 50 restarts over the one array column."""
    _, _, out = kmeans_label(tbl(spark, d, "embeddings"), "embedding", k=10, seed=0)
    return out.select("vec_id", F.col("Cluster").cast("int").alias("cluster"))


def centres():
    """Three fixed centres generated by rule: c_j[i] = 0.1 (j+1) (-1)^i."""
    return [[0.1 * (j + 1) * (-1) ** i for i in range(N_DIMS)] for j in range(3)]


def _centre_sql(j, c):
    lit = "[" + ", ".join(repr(float(x)) for x in c) + "]"
    return (f"round(sqrt(list_sum(list_transform(list_zip(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), "
            f"{lit}), lambda p: (p[1] - p[2]) * (p[1] - p[2])))), 6) AS Centroid{j}")


@register("centroid_distance", sql="SELECT vec_id, " + ", ".join(
    _centre_sql(j, c) for j, c in enumerate(centres())) + " FROM embeddings")
def centroid_distance(spark, d):
    vector = F.transform("embedding", lambda x: x.cast("double"))
    e = tbl(spark, d, "embeddings").select("vec_id", vector_distances(vector, centres()).alias("far"))
    return e.select("vec_id", *[F.round(F.get("far", F.lit(i)), 6).alias(f"Centroid{i}") for i in range(3)])


@register("pca_project")
def q_pca_project(spark, d):
    model, out = pca_project(tbl(spark, d, "embeddings"), "embedding", 3)
    return out.select("vec_id", *[F.round(F.get("pca", F.lit(i)), 6).alias(f"pc{i + 1}") for i in range(3)])


@register("pca_covariance", sql="""
WITH x AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
SELECT CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j, round(covar_samp(a.v, b.v), 9) AS cov
FROM x a JOIN x b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY a.i, b.i""")
def pca_covariance(spark, d):
    """The covariance matrix that the one-pass fit sums up."""
    c = fit_pca(tbl(spark, d, "embeddings"), "embedding", 3).covariance
    rows = [(i, j, float(c[i, j])) for i in range(len(c)) for j in range(i, len(c))]
    return spark.createDataFrame(rows, "i int, j int, cov double").withColumn("cov", r("cov", 9))


def _checks(spark, values):
    return spark.createDataFrame([(k, float(v)) for k, v in values.items()], "check string, value double").select(
        F.col("check").alias("check_name"), r("value").alias("value"))


def _checks_sql(**values) -> str:
    return "\nUNION ALL\n".join(f"SELECT '{k}' AS check_name, round(CAST(({v}) AS DOUBLE), 6) AS value" for k, v in values.items())


_DIMS_SQL = "(SELECT generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)"


@register("pca_checks", sql=_checks_sql(
    rows="SELECT count(*) FROM embeddings", orthonormal="1", eigen_residual_is_zero="1", variances_are_eigenvalues="1",
    projections_are_uncorrelated="1", total_variance=f"SELECT sum(s) FROM (SELECT var_samp(v) AS s FROM {_DIMS_SQL} GROUP BY i)"))
def pca_checks(spark, d):
    """What makes a projection a principal one: unit axes, C a = lambda a, and projections of
    variance lambda that do not correlate (E10)."""
    import numpy as np
    model, out = pca_project(tbl(spark, d, "embeddings"), "embedding", 3)
    pc = [F.get("pca", F.lit(i)) for i in range(3)]
    row = out.agg(F.count("pca").alias("n"), *[F.covar_samp(pc[i], pc[j]).alias(f"c{i}{j}") for i in range(3) for j in range(i, 3)]).first()
    a, lam = np.array(model.components), np.array(model.variances)
    return _checks(spark, {
        "rows": row["n"], "orthonormal": np.allclose(a @ a.T, np.eye(3)),
        "eigen_residual_is_zero": np.allclose(model.covariance @ a.T, a.T * lam),
        "variances_are_eigenvalues": np.allclose([row[f"c{i}{i}"] for i in range(3)], lam),
        "projections_are_uncorrelated": np.allclose([row["c01"], row["c02"], row["c12"]], 0, atol=1e-9),
        "total_variance": np.trace(model.covariance)})


@register("kmeans_checks", sql=_checks_sql(
    rows="SELECT count(*) FROM embeddings", restarts="50", clusters="10", labels_off_the_nearest_centre="0",
    centres_are_member_means="1", cost_is_the_sum_of_squares="1", no_restart_is_better="1"))
def kmeans_checks(spark, d):
    """What makes labels k-means labels: every row at its nearest centre, every centre the mean of
    its rows, and the least cost of 50 restarts (F3, F4)."""
    import numpy as np
    fit, centres, out = kmeans_label(tbl(spark, d, "embeddings"), "embedding", k=10, seed=0)
    out = out.select(F.col("Cluster").alias("c"), fit.scaled.alias("v"), fit.distances.alias("far"))
    off = F.sum((F.get("far", F.col("c")) > F.array_min("far")).cast("long"))
    per = out.groupBy("c").agg(F.count("*").alias("n"), off.alias("off"), F.sum(F.pow(F.array_min("far"), 2)).alias("cost"),
                               *[F.avg(F.get("v", F.lit(i))).alias(f"m{i}") for i in range(N_DIMS)]).collect()  # a row per cluster
    means = {r["c"]: [r[f"m{i}"] for i in range(N_DIMS)] for r in per}
    return _checks(spark, {
        "rows": sum(r["n"] for r in per), "restarts": len(fit.costs), "clusters": len(centres),
        "labels_off_the_nearest_centre": sum(r["off"] for r in per),
        "centres_are_member_means": all(np.allclose(means[c], centres[c], atol=1e-3) for c in means),
        "cost_is_the_sum_of_squares": np.isclose(sum(r["cost"] for r in per), fit.cost),
        "no_restart_is_better": fit.cost == min(fit.costs)})


_ONE_HOT = ", ".join(f"CAST(a.c = {i} AS INTEGER) AS f{2 + i}" for i in range(5)) + ", " + ", ".join(
    f"CAST(b.c = {i} AS INTEGER) AS f{7 + i}" for i in range(5))


@register("feature_vector", sql=f"""
WITH {OC_SQL},
m AS (SELECT avg(price_n) AS mp, avg(c_acctbal) AS ma FROM OC WHERE is_train),
f AS (SELECT o_orderkey, is_train, o_orderpriority, c_mktsegment, coalesce(price_n, mp) AS p, coalesce(c_acctbal, ma) AS q FROM OC CROSS JOIN m),
s AS (SELECT avg(p) AS pm, stddev_pop(p) AS ps, avg(q) AS qm, stddev_pop(q) AS qs FROM f WHERE is_train),
a AS (SELECT o_orderpriority, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS c FROM OC WHERE is_train GROUP BY 1),
b AS (SELECT c_mktsegment, row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS c FROM OC WHERE is_train GROUP BY 1)
SELECT o_orderkey, round((p - pm) / ps, 6) AS f0, round((q - qm) / qs, 6) AS f1, {_ONE_HOT}
FROM f CROSS JOIN s JOIN a USING (o_orderpriority) JOIN b USING (c_mktsegment)""")
def feature_vector(spark, d):
    """Mean fill, population z-score and one-hot (levels by frequency) as one vector."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    oc = OC(spark, d)
    stages = M.feature_assembler(["price_n", "c_acctbal"], ["o_orderpriority", "c_mktsegment"])
    model = Pipeline(stages=stages).fit(oc.where(F.col("is_train")))
    x = model.transform(oc).select("o_orderkey", vector_to_array("features").alias("f"))
    return x.select("o_orderkey", *[F.round(F.col("f")[i], 6).alias(f"f{i}") for i in range(2)],
                    *[F.col("f")[i].cast("int").alias(f"f{i}") for i in range(2, 12)])


# ---- V1-V3 -----------------------------------------------------------------------------

H_SQL = "((o_orderkey * 7919 + 42) % 10007)"
def _hash():
    return (F.col("o_orderkey") * 7919 + 42) % 10007


@register("holdout_split", sql=f"""
SELECT o_orderkey, CAST({H_SQL} < 0.2 * 10007 AS INTEGER) AS is_test FROM orders""")
def holdout_split(spark, d):
    o = tbl(spark, d, "orders")
    return o.select("o_orderkey", V.holdout_flag(_hash(), 0.2, 10007).alias("is_test"))


@register("stratified_split", sql=f"""
WITH a AS (SELECT o_orderkey, o_orderstatus, {H_SQL} AS h FROM orders),
b AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY h, o_orderkey) - 1 AS rk,
             count(*) OVER (PARTITION BY o_orderstatus) AS nc FROM a)
SELECT o_orderkey, o_orderstatus, CAST(rk < ceil(0.1 * nc) AS INTEGER) AS is_test FROM b""")
def stratified_split(spark, d):
    o = tbl(spark, d, "orders").select("o_orderkey", "o_orderstatus", _hash().alias("h"))
    out = V.stratified_holdout(o, "o_orderstatus", "h", "o_orderkey", 0.1)
    return out.select("o_orderkey", "o_orderstatus", "is_test")


@register("fold_assign", sql=f"""
WITH a AS (SELECT o_orderkey, {H_SQL} AS h, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx,
                  count(*) OVER () AS n FROM orders),
b AS (SELECT *, n // 5 AS q, n % 5 AS rr FROM a)
SELECT o_orderkey, CAST(CASE WHEN idx < rr * (q + 1) THEN idx // (q + 1) ELSE rr + (idx - rr * (q + 1)) // q END
       AS INTEGER) AS fold_contiguous, CAST(h % 5 AS INTEGER) AS fold_hashed FROM b""")
def fold_assign(spark, d):
    o = tbl(spark, d, "orders").select("o_orderkey", _hash().alias("h"))
    out = V.contiguous_folds(o, "o_orderkey", 5, "fold_contiguous")
    return out.select("o_orderkey", "fold_contiguous", V.hashed_folds("h", 5).alias("fold_hashed"))


# ---- V4-V7 -----------------------------------------------------------------------------

@register("metrics_classification", sql=f"""
WITH {S_SQL},
a AS (SELECT o_orderpriority, CAST(sum(CASE WHEN y = 1 AND p1 > 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
  CAST(sum(CASE WHEN y <> 1 AND p1 > 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN y = 1 AND NOT p1 > 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
  CAST(sum(CASE WHEN y <> 1 AND NOT p1 > 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS tn FROM S GROUP BY 1)
SELECT o_orderpriority, tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
  round(coalesce(CASE WHEN tp + fp = 0 THEN NULL ELSE tp / (tp + fp) END, 0.0), 6) AS precision,
  round(coalesce(CASE WHEN tp + fn = 0 THEN NULL ELSE tp / (tp + fn) END, 0.0), 6) AS recall,
  round(coalesce(CASE WHEN 2 * tp + fp + fn = 0 THEN NULL ELSE 2 * tp / (2 * tp + fp + fn) END, 0.0), 6) AS f1
FROM a""")
def metrics_classification(spark, d):
    s = S(spark, d).withColumn("pred", (F.col("p1") > 0.5).cast("int"))
    m = V.classification_metrics(s, "y", "pred", ["o_orderpriority"])
    return m.select("o_orderpriority", "tp", "fp", "fn", "tn",
                    *[r(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@register("metric_auc", sql=f"""
WITH {S_SQL},
per AS (SELECT p1, sum(CASE WHEN y = 1 THEN 1.0 ELSE 0.0 END) AS pos, sum(CASE WHEN y <> 1 THEN 1.0 ELSE 0.0 END) AS neg
        FROM S GROUP BY p1),
cum AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY p1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM per)
SELECT round(sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS auc FROM cum""")
def metric_auc(spark, d):
    return V.roc_auc_table(S(spark, d), "y", "p1").select(r("auc").alias("auc"))


_REG_SQL = f"""WITH {S_SQL}, P AS (SELECT o_totalprice AS yv, o_totalprice * (0.8 + 0.4 * p1) AS pv FROM S)"""


@register("metrics_regression", sql=_REG_SQL + """
SELECT round(avg(abs(pv - yv)), 4) AS mae, round(avg((pv - yv) * (pv - yv)) / 1e6, 4) AS mse_m,
  round(sqrt(avg((pv - yv) * (pv - yv))), 4) AS rmse,
  round(1 - sum((pv - yv) * (pv - yv)) / (var_pop(yv) * count(*)), 6) AS r2,
  round(sqrt(avg((ln(1 + pv) - ln(1 + yv)) * (ln(1 + pv) - ln(1 + yv)))), 6) AS rmsle,
  round(avg(abs(ln(1 + pv) - ln(1 + yv))), 6) AS mae_log FROM P""")
def metrics_regression(spark, d):
    s = S(spark, d).select(F.col("o_totalprice").alias("yv"),
                           (F.col("o_totalprice") * (0.8 + 0.4 * F.col("p1"))).alias("pv"))
    m = V.regression_metrics(s, "yv", "pv")
    return m.select(r("mae", 4).alias("mae"), r(F.col("mse") / 1e6, 4).alias("mse_m"), r("rmse", 4).alias("rmse"),
                    r("r2").alias("r2"), r("rmsle").alias("rmsle"), r("mae_log").alias("mae_log"))


@register("metric_smape", sql=_REG_SQL + """
SELECT round(avg(2.0 * abs(pv - yv) / (abs(yv) + abs(pv) + 1e-8)) * 100.0, 6) AS smape,
       round(avg(2.0 * abs(ln(1 + pv) - ln(1 + yv)) / (abs(ln(1 + yv)) + abs(ln(1 + pv)) + 1e-8)) * 100.0, 6)
       AS smape_log FROM P""")
def metric_smape(spark, d):
    s = S(spark, d).select(F.col("o_totalprice").alias("yv"),
                           (F.col("o_totalprice") * (0.8 + 0.4 * F.col("p1"))).alias("pv"))
    return s.agg(r(V.smape(s, "yv", "pv")).alias("smape"),
                 r(V.smape(s, "yv", "pv", transform=F.log1p)).alias("smape_log"))


# ---- M7-M12, M14 -----------------------------------------------------------------------

def _sweep_sql(metric_expr: str, larger: bool, digits: int = 6) -> str:
    best = "max" if larger else "min"
    return f"""WITH {S_SQL},
W AS (SELECT i, CAST(i AS DOUBLE) * CAST(0.01 AS DOUBLE) AS w FROM range(0, 101) t(i)),
X AS (SELECT i, w, w * a + (1.0 - w) * b AS p, yv FROM W CROSS JOIN (SELECT {{a}} AS a, {{b}} AS b, {{y}} AS yv FROM S)),
M AS (SELECT i, any_value(w) AS w, {metric_expr} AS metric FROM X GROUP BY i),
B AS (SELECT min(i) AS bi FROM M WHERE metric = (SELECT {best}(metric) FROM M))
SELECT round(w, 2) AS w, round(metric, {digits}) AS metric, CAST(i = bi AS INTEGER) AS best FROM M CROSS JOIN B"""


@register("blend_sweep_accuracy", sql=_sweep_sql(
    "avg(CASE WHEN CAST(p > 0.5 AS DOUBLE) = yv THEN 1.0 ELSE 0.0 END)", True).format(
    a="p1", b="p2", y="CAST(y AS DOUBLE)"))
def blend_sweep_accuracy(spark, d):
    out = M.blend_sweep(S(spark, d), "y", "p1", "p2", "accuracy")
    return out.select(r("w", 2).alias("w"), r("metric").alias("metric"), "best")


_SCALED = dict(a="o_totalprice * (0.9 + 0.2 * p1)", b="o_totalprice * (1.1 - 0.3 * p2)", y="o_totalprice")


def _scaled(spark, d):
    return S(spark, d).select(F.col("o_totalprice").alias("yv"),
                              (F.col("o_totalprice") * (0.9 + 0.2 * F.col("p1"))).alias("a"),
                              (F.col("o_totalprice") * (1.1 - 0.3 * F.col("p2"))).alias("b"))


@register("blend_sweep_rmsle", sql=_sweep_sql("sqrt(avg((ln(1 + p) - ln(1 + yv)) * (ln(1 + p) - ln(1 + yv))))",
                                              False).format(**_SCALED))
def blend_sweep_rmsle(spark, d):
    out = M.blend_sweep(_scaled(spark, d), "yv", "a", "b", "rmsle")
    return out.select(r("w", 2).alias("w"), r("metric").alias("metric"), "best")


@register("blend_sweep_mae", sql=_sweep_sql("avg(abs(p - yv))", False, 4).format(**_SCALED))
def blend_sweep_mae(spark, d):
    out = M.blend_sweep(_scaled(spark, d), "yv", "a", "b", "mae")
    return out.select(r("w", 2).alias("w"), r("metric", 4).alias("metric"), "best")


@register("threshold_f1", sql=f"""
WITH {S_SQL},
T AS (SELECT CAST(i AS DOUBLE) / 1000.0 AS threshold FROM range(100, 901) t(i)),
C AS (SELECT threshold, CAST(sum(CASE WHEN y = 1 AND p1 > threshold THEN 1 ELSE 0 END) AS BIGINT) AS tp,
        CAST(sum(CASE WHEN y <> 1 AND p1 > threshold THEN 1 ELSE 0 END) AS BIGINT) AS fp,
        CAST(sum(CASE WHEN y = 1 AND NOT p1 > threshold THEN 1 ELSE 0 END) AS BIGINT) AS fn
      FROM T CROSS JOIN S GROUP BY threshold),
F AS (SELECT *, coalesce(CASE WHEN 2 * tp + fp + fn = 0 THEN NULL ELSE 2.0 * tp / (2 * tp + fp + fn) END, 0.0) AS f1 FROM C),
B AS (SELECT threshold AS bt FROM F ORDER BY f1 DESC, threshold ASC LIMIT 1)
SELECT round(threshold, 3) AS threshold, tp, fp, fn, round(f1, 6) AS f1, CAST(threshold = bt AS INTEGER) AS best
FROM F CROSS JOIN B""")
def threshold_f1(spark, d):
    grid = spark.range(100, 901).select((F.col("id").cast("double") / 1000.0).alias("t"))
    sweep = M.threshold_sweep(S(spark, d), "y", "p1", grid)
    out = M.mark_best(sweep, "f1", "threshold")
    return out.select(r("threshold", 3).alias("threshold"), "tp", "fp", "fn", r("f1").alias("f1"), "best")


@register("post_adjust", sql=f"""
WITH {S_SQL}
SELECT o_orderkey, round(p1 * 1000 + 2700, 6) AS adj_const,
  round(CASE WHEN p2 > 0.4 THEN p2 + 0.1 ELSE p2 - 0.1 END, 6) AS adj_step,
  CAST(p1 > 0.5 AS INTEGER) AS as_bool FROM S""")
def post_adjust(spark, d):
    s = S(spark, d)
    return s.select("o_orderkey", r(M.post_adjust(F.col("p1") * 1000, add=2700)).alias("adj_const"),
                    r(M.post_adjust("p2", step_threshold=0.4, step=0.1)).alias("adj_step"),
                    M.apply_threshold("p1", 0.5).alias("as_bool"))


# ---- Spark ML fits (rows-only checks) ------------------------------------------------

def _oc_features(spark, d):
    oc = OC(spark, d).withColumns({"o_month": F.month("o_orderdate").cast("double"),
                                   "label_reg": F.log1p("o_totalprice"),
                                   "label_cls": F.col("y").cast("double")})
    stages = M.feature_assembler(["o_month", "c_acctbal"], ["o_orderpriority", "c_mktsegment"])
    return oc, stages


@register("fit_gbt_regressor")
def fit_gbt_regressor(spark, d):
    oc, stages = _oc_features(spark, d)
    est = M.gbt_regressor("label_reg")
    _, pred = M.fit_apply(stages + [est], oc.where(F.col("is_train")), oc.where(~F.col("is_train")))
    return pred.select("o_orderkey", F.expm1("prediction").alias("prediction"))


@register("fit_gbt_classifier")
def fit_gbt_classifier(spark, d):
    from pyspark.ml.functions import vector_to_array
    oc, stages = _oc_features(spark, d)
    # early stopping on a 10 % hash hold-out of the train rows (M2)
    oc = oc.withColumn("is_val", V.holdout_flag(_hash(), 0.1, 10007).cast("boolean"))
    est = M.gbt_classifier("label_cls", validation_col="is_val")
    _, pred = M.fit_apply(stages + [est], oc.where(F.col("is_train")), oc.where(~F.col("is_train")))
    return pred.select("o_orderkey", vector_to_array("probability")[1].alias("p_default"),
                       F.col("prediction").cast("int").alias("prediction"))


def _emb_vec(spark, d):
    from pyspark.ml.functions import array_to_vector
    e = tbl(spark, d, "embeddings")
    return e.select("vec_id", F.col("label").cast("double").alias("label"),
                    array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"))


@register("fit_multiclass")
def fit_multiclass(spark, d):
    e = _emb_vec(spark, d)
    train, test = e.where(F.col("vec_id") % 5 != 0), e.where(F.col("vec_id") % 5 == 0)
    model = M.multiclass_classifier("label").fit(train)
    return model.transform(test).select("vec_id", F.col("prediction").cast("int").alias("prediction"))


# Coarse topic groups of the ten labels.
COARSE = {0: 0, 1: 0, 2: 0, 3: 0, 4: 1, 5: 1, 6: 1, 7: 2, 8: 2, 9: 2}


@register("two_stage_classify")
def two_stage_classify(spark, d):
    e = _emb_vec(spark, d)
    train, test = e.where(F.col("vec_id") % 5 != 0), e.where(F.col("vec_id") % 5 == 0)
    out = M.two_stage_classify(train, test, "label", COARSE)
    return out.select("vec_id", F.col("prediction").cast("int").alias("prediction"))


@register("pseudo_label")
def pseudo_label(spark, d):
    e = _emb_vec(spark, d)
    train, test = e.where(F.col("vec_id") % 5 != 0), e.where(F.col("vec_id") % 5 == 0)
    out = M.pseudo_label(train, test.drop("label"), "label", lambda: M.multiclass_classifier("label"))
    return out.select("vec_id", F.col("prediction").cast("int").alias("prediction"))


def _cv_frame(spark, d):
    oc, stages = _oc_features(spark, d)
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    prep = Pipeline(stages=stages).fit(oc.where(F.col("is_train")))
    data = prep.transform(oc).select(
        "o_orderkey", "is_train", vector_to_array("features").alias("x"), "label_cls", V.hashed_folds(_hash(), 3).alias("fold"))
    return data.where("is_train"), data.where("NOT is_train")


@register("cv_score")
def cv_score(spark, d):
    """Mean accuracy and log loss of one candidate over three folds (V3)."""
    train, _ = _cv_frame(spark, d)
    rows = B.cross_validate(train, "x", "label_cls", "o_orderkey", "fold", [B.Candidate()])
    return spark.createDataFrame([(r["rounds"], r["accuracy"], r["loss"]) for r in rows], "rounds int, accuracy double, logloss double")


#: The 144 combinations of the search (fixed values).
SEARCH_GRID = [B.Candidate(depth, rate, l2, temperature) for depth in (3, 5, 7, 9) for rate in (0.01, 0.1, 0.2, 0.3)
               for l2 in (1.0, 5.0, 10.0) for temperature in (0.0, 0.5, 1.0)]
TRIALS = ("max_depth int, learning_rate double, l2 double, bagging_temperature double, rounds int, accuracy double, "
          "logloss double, best int, test_accuracy double")


def _trial_table(spark, found, test):
    """The trials; the best one with its refitted model's accuracy on the test part."""
    right = (found.model.score("x") > 0.5).cast("double") == F.col("label_cls")
    accuracy = test.agg(F.avg(right.cast("double"))).first()[0]
    return spark.createDataFrame([(t["depth"], t["learning_rate"], t["l2"], t["bagging_temperature"], t["rounds"], t["accuracy"],
                                   t["loss"], t["best"], accuracy if t["best"] else None) for t in found.trials], TRIALS)


@register("grid_search")
def grid_search(spark, d):
    """All 144 combinations x 3 folds x 100 rounds by accuracy, the best refitted (V8)."""
    train, test = _cv_frame(spark, d)
    return _trial_table(spark, B.grid_search(train, "x", "label_cls", "o_orderkey", "fold", SEARCH_GRID), test)


@register("random_search")
def random_search(spark, d):
    """5 random and 15 guided trials by successive halving, the best refitted (V9)."""
    train, test = _cv_frame(spark, d)
    bounds = {"depth": (3, 10), "learning_rate": (0.01, 0.3), "l2": (1.0, 10.0), "bagging_temperature": (0.0, 1.0)}
    return _trial_table(spark, B.random_search(train, "x", "label_cls", "o_orderkey", "fold", bounds), test)


@register("staged_checks", sql=f"""
WITH {OC_SQL}, t AS (SELECT y, row_number() OVER (PARTITION BY y ORDER BY {H_SQL}, o_orderkey) AS k, count(*) OVER (PARTITION BY y) AS n FROM OC WHERE is_train),
v AS (SELECT * FROM t WHERE k <= ceil(0.1 * n))
""" + _checks_sql(table_rows="30 * 81", holdout_rows="SELECT count(*) FROM v", holdout_positives="SELECT sum(y) FROM v",
                  counts_add_up="1", best_is_the_largest_f1="1", one_best="1"))
def staged_checks(spark, d):
    """Best round and threshold chosen together on a stratified 10 % hold-out."""
    oc, stages = _oc_features(spark, d)
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    train = V.stratified_holdout(oc.where("is_train").withColumn("h", _hash()), "y", "h", "o_orderkey", 0.1, "is_val")
    prep = Pipeline(stages=stages).fit(oc.where("is_train"))
    ready = cut_lineage(prep.transform(train).select("o_orderkey", "is_val", "label_cls", vector_to_array("features").alias("x")))
    model = B.boost(ready.where("is_val = 0"), "x", "label_cls", [B.Job(B.Candidate(4, 0.2))], "o_orderkey", rounds=30).models[0]
    held = ready.where("is_val = 1")
    table = B.staged_thresholds(held, model, "x", "label_cls", [t / 100 for t in range(10, 91)]).collect()
    truth = held.agg(F.count("*").alias("n"), F.sum("label_cls").alias("p")).first()
    best = [t for t in table if t["best"]]
    return _checks(spark, {
        "table_rows": len(table), "holdout_rows": truth["n"], "holdout_positives": truth["p"],
        "counts_add_up": all(t["tp"] + t["fn"] == truth["p"] and t["fp"] <= truth["n"] - truth["p"] for t in table),
        "best_is_the_largest_f1": best[0]["f1"] == max(t["f1"] for t in table), "one_best": len(best) == 1})


@register("fit_apply_model")
def fit_apply_model(spark, d):
    """Fit a pipeline on train, save it to the shared folder, load it back and
    score the test part (M15)."""
    import uuid

    from pyspark.ml import PipelineModel
    from pyspark.ml.regression import RandomForestRegressor
    oc, stages = _oc_features(spark, d)
    model, _ = M.fit_apply(stages + [RandomForestRegressor(labelCol="label_reg", seed=0)],
                           oc.where(F.col("is_train")), oc.limit(0))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    return loaded.transform(oc.where(~F.col("is_train"))).select("o_orderkey", F.expm1("prediction").alias("prediction"))


@register("impute_model_rf")
def impute_model_rf(spark, d):
    from ..operators.impute import ModelImputer
    p = tbl(spark, d, "part").withColumn(
        "p_size", F.when(F.col("p_partkey") % 9 == 0, F.lit(None).cast("int")).otherwise(F.col("p_size")))
    model = ModelImputer("p_size", ["p_brand", "p_type"], ["p_retailprice"]).fit(p)
    return model.transform(p).select("p_partkey", "p_size")


@register("model_checks", sql=_checks_sql(
    loaded_model_differs="0", class_is_not_the_likeliest="0", probabilities_not_summing_to_one="0", known_values_changed="0",
    values_left_missing="0", test_rows="SELECT count(*) FROM embeddings WHERE vec_id % 5 = 0"))
def model_checks(spark, d):
    """A loaded model predicts as the fitted one (M15), a class is the arg-max of its probabilities
    (M3), a model fill keeps what is known and leaves nothing missing (I12)."""
    import uuid

    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.regression import RandomForestRegressor

    from ..operators.impute import ModelImputer
    oc, stages = _oc_features(spark, d)
    test = oc.where(~F.col("is_train"))
    model, fitted = M.fit_apply(stages + [RandomForestRegressor(labelCol="label_reg", seed=0)], oc.where("is_train"), test)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    model.write().save(path)
    loaded = PipelineModel.load(path).transform(test).select("o_orderkey", F.col("prediction").alias("again"))
    differs = fitted.join(loaded, "o_orderkey").where(~F.col("prediction").eqNullSafe(F.col("again"))).count()

    e = _emb_vec(spark, d)
    scored = M.multiclass_classifier("label").fit(e.where(F.col("vec_id") % 5 != 0)).transform(e.where(F.col("vec_id") % 5 == 0))
    p = vector_to_array("prediction_prob")
    likeliest = F.array_position(p, F.array_max(p)) - 1
    row = scored.agg(F.count("*").alias("n"), F.sum((F.col("prediction").cast("int") != likeliest).cast("long")).alias("off"),
                     F.sum((F.abs(F.aggregate(p, F.lit(0.0), lambda a, x: a + x) - 1) > 1e-9).cast("long")).alias("bad")).first()

    known = F.when(F.col("p_partkey") % 9 != 0, F.col("p_size"))
    part = tbl(spark, d, "part").withColumns({"p_size": known, "truth": known})
    filled = ModelImputer("p_size", ["p_brand", "p_type"], ["p_retailprice"], num_trees=20).fit(part).transform(part)
    f = filled.agg(F.sum((F.col("truth").isNotNull() & (F.col("p_size") != F.col("truth"))).cast("long")).alias("changed"),
                   F.sum(F.col("p_size").isNull().cast("long")).alias("missing")).first()
    return _checks(spark, {"loaded_model_differs": differs, "class_is_not_the_likeliest": row["off"],
                           "probabilities_not_summing_to_one": row["bad"], "known_values_changed": f["changed"],
                           "values_left_missing": f["missing"], "test_rows": row["n"]})


# ---- S5, S6: sinks ---------------------------------------------------------------------

def _shared_path(spark, stem):
    import uuid
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{stem}-{uuid.uuid4().hex}"


@register("write_predictions", sql=f"""
WITH {S_SQL}
SELECT o_orderkey AS id, round(0.7 * p1 + (CAST(1.0 AS DOUBLE) - CAST(0.7 AS DOUBLE)) * p2, 6) AS prediction
FROM S WHERE NOT is_train""")
def write_predictions(spark, d):
    """(id, prediction) of the test part written as header CSV and read back."""
    from pyspark.sql import types as T

    from ..sources import io
    s = S(spark, d).where(~F.col("is_train"))
    pred = s.select("o_orderkey", r(M.apply_blend("p1", "p2", 0.7)).alias("pred"))
    path = _shared_path(spark, "predictions")
    io.write_csv(io.prediction_table(pred, "o_orderkey", "pred", "id", "prediction"), path)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("prediction", T.DoubleType())])
    return io.read_csv(spark, path, schema)


@register("write_feature_scores", sql=_MI_DISCRETE_SQL.replace(
    "SELECT feature, round(sum(n / tot * ln(n * tot / (nx * ny))), 6) AS mi",
    "SELECT feature AS \"Feature\", round(sum(n / tot * ln(n * tot / (nx * ny))), 6) AS \"MI Score\""))
def write_feature_scores(spark, d):
    """The (Feature, MI Score) table, sorted by score, written as CSV and read back."""
    from pyspark.sql import types as T

    from ..sources import io
    mi = SC.ranked_scores(SC.mi_discrete(OC(spark, d), MI_FEATURES, "y"))
    table = mi.select(F.col("feature").alias("Feature"), r("mi").alias("MI Score"))
    path = _shared_path(spark, "feature-scores")
    io.write_csv(table.coalesce(1), path)
    schema = T.StructType([T.StructField("Feature", T.StringType()), T.StructField("MI Score", T.DoubleType())])
    return io.read_csv(spark, path, schema)


_UPTO = "(CASE WHEN {x} <= g THEN 0 ELSE ({x} - 1 - g) // 5 + 1 END)"


@register("fold_assign_stratified", sql=f"""
WITH c AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1),
s AS (SELECT o_orderstatus, n,
        coalesce(sum(n) OVER (ORDER BY o_orderstatus ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS st
      FROM c),
b AS (SELECT o_orderstatus, list_transform(range(1, 6), lambda f: list_sum(list_transform(range(0, f),
        lambda g: {_UPTO.format(x='(st + n)')} - {_UPTO.format(x='st')}))) AS upper FROM s),
r AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS rk
      FROM orders)
SELECT o_orderkey, CAST(len(list_filter(upper, lambda x: rk >= x)) AS INTEGER) AS fold_stratified
FROM r JOIN b USING (o_orderstatus)""")
def fold_assign_stratified(spark, d):
    """Unshuffled stratified 5-fold by order status, in order-key order (V3)."""
    o = tbl(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return V.stratified_folds(o, "o_orderkey", "o_orderstatus", 5, "fold_stratified") \
        .select("o_orderkey", "fold_stratified")
