"""C7 math_prob: cleaned question text and its count/flag features, the label
distribution, and the text model (TF-IDF block + scaled numerics, two-stage
classifier, pseudo-labelling with a last fit over all labels)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import strings as S
from ..operators import models as M
from ..operators.groupstats import attach_group_stat
from ..operators.scaling import PopulationScaler
from ..operators.text import tfidf_vector_pipeline

# Topic patterns and keyword groups of the math-text features.
TOPICS = {
    "equation_count": r"equals|equation|formula|solve for",
    "function_count": r"function|f\(x\)|derivative|integral",
    "geometry_count": r"angle|triangle|circle|area|volume",
    "algebra_count": r"variable|polynomial|matrix|vector",
    "calculus_count": r"derivative|integral|limit|differentiation",
    "prob_count": r"probability|random|random variable",
    "topo_count": r"ring|abelian|nonabelian",
}
FLAGS = {"is_proof": ["prove", "show that"], "is_compute": ["compute", "calculate"],
         "is_find": ["find", "determine"], "is_matrix": ["matrix", "matrices"]}
SYMBOLS = r"[\p{Nd}+\-*/=()<>^√π÷%.]"


def preprocess(df: DataFrame) -> DataFrame:
    df = df.withColumns({"id": F.coalesce(F.col("id"), F.lit(-1)), "label": F.coalesce(F.col("label"), F.lit(-1))})
    df = df.withColumn("Question", S.clean_math_text("Question"))
    q = F.col("Question")
    length = S.text_length(q)
    sym = S.regex_count(q, SYMBOLS)
    cols = {"length": length, "log_length": F.log1p(length), "numeric_token_counts": sym,
            "log_numeric_token_counts": F.log1p(sym), "num_count": S.regex_count(q, r"\p{Nd}+"),
            "word_count": S.word_count(q).cast("long")}
    cols.update({n: S.regex_count(q, p) for n, p in TOPICS.items()})
    cols.update({n: S.contains_any(q, ws) for n, ws in FLAGS.items()})
    return df.withColumns(cols)


def label_distribution(df: DataFrame) -> DataFrame:
    """Count and percent (2 places, half-even) of each known label, by label."""
    known = df.where(F.col("label") != -1)
    c = known.groupBy("label").agg(F.count(F.lit(1)).alias("count")).withColumn("__k", F.lit(1))
    c = attach_group_stat(c, ["__k"], "count", "sum", "__total")
    return c.select("label", "count", F.bround(F.col("count") * 100.0 / F.col("__total"), 2).alias("percent")) \
            .orderBy("label")


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("Question", "label", "id")]


def fit_predict(df: DataFrame, group_map: dict[int, int], max_features: int = 5000, num_trees: int = 20,
                pseudo: bool = True) -> DataFrame:
    """TF-IDF on train questions, population-scaled numerics, one feature
    vector; two-stage classification; with ``pseudo``, one global model is then
    fitted on the known rows and the guessed ones."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    train, test = df.where(F.col("id") == -1), df.where(F.col("id") != -1)
    tfidf = tfidf_vector_pipeline("Question", "__text", max_features).fit(train)
    nums = numeric_columns(df)
    scale = Pipeline(stages=[VectorAssembler(inputCols=nums, outputCol="__num", handleInvalid="keep"),
                             PopulationScaler("__num", "__nums")]) \
        .fit(train)
    both = VectorAssembler(inputCols=["__text", "__nums"], outputCol="features")

    def prep(x):
        return both.transform(scale.transform(tfidf.transform(x))).select(
            "id", F.col("label").cast("double").alias("label"), "features")

    tr, te = prep(train), prep(test)
    out = M.two_stage_classify(tr, te, "label", group_map, num_trees=num_trees)
    if pseudo:
        guessed = out.select("id", F.col("prediction").alias("label"), "features")
        # the last fit is one model over all labels, on the known and the guessed rows
        final = M.multiclass_classifier("label", num_trees=num_trees).fit(tr.unionByName(guessed))
        out = final.transform(te.drop("label"))
    return out.select("id", F.col("prediction").cast("int").alias("label"))
