"""C8 math_exam: age/experience transforms and bins, price ratios to group
means, subject counts and bit-packed subject code, k-means label, MI selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..core import cut_lineage
from ..functions import binning as B
from ..functions import columns as C
from ..operators.cluster import cluster_with_distances
from ..operators.groupstats import attach_group_stat, attach_group_stats
from .common import drop_uninformative

CLUSTER_FEATURES = ["lesson_subject_binary", "lesson_experience", "square_price", "lesson_qualification",
                    "lesson_age"]
SUBJECTS = ["physics", "chemistry", "biology", "english", "geography", "history"]
DROPPED = ["age_bin", "mean_price_by_age_bin", "month_of_experience", "years_of_experience",
           "mean_price_by_experience", "mean_price_by_qualification", "mean_price_by_subject_binary",
           "total_subject_binary"]


def features(df: DataFrame) -> DataFrame:
    """The deterministic features, before clusters."""
    df = df.withColumn("mean_exam_points", F.coalesce(F.col("mean_exam_points"), F.lit(0.0)))
    df = C.cast_numeric(df)
    df = df.withColumn("log_age", C.ln("age"))
    df = df.withColumn("years_of_experience", C.substitute_below("years_of_experience", 1.0, 0.5))
    df = df.withColumns({"month_of_experience": F.col("years_of_experience") * 12,
                         "log_years_of_experience": C.log1p("years_of_experience"),
                         "start_tutor": F.col("age") - F.col("years_of_experience")})
    df = df.withColumns({"log_month_of_experience": C.ln("month_of_experience"),
                         "age_bin": B.ladder("age", [20, 30, 40, 50, 60], [1, 2, 3, 4, 5], 6)})
    df = df.withColumn("square_price", F.col("lesson_price") * F.col("lesson_price"))
    df = attach_group_stats(df, ["age_bin", "years_of_experience", "qualification"], "lesson_price", "mean",
                            ["mean_price_by_age_bin", "mean_price_by_experience", "mean_price_by_qualification"])
    df = df.withColumns({"lesson_age": F.col("lesson_price") / F.col("mean_price_by_age_bin"),
                         "lesson_experience": F.col("lesson_price") / F.col("mean_price_by_experience"),
                         "lesson_qualification": F.col("lesson_price") / F.col("mean_price_by_qualification"),
                         "total_subject": sum((F.col(s) for s in SUBJECTS), F.lit(0.0)),
                         "total_subject_binary": C.bitpack(list(reversed(SUBJECTS)))})
    df = attach_group_stat(df, ["total_subject_binary"], "lesson_price", "mean", "mean_price_by_subject_binary")
    return df.withColumn("lesson_subject_binary", F.col("lesson_price") / F.col("mean_price_by_subject_binary"))


def preprocess(df: DataFrame, k: int = 10, restarts: int = 50, select: bool = True, threshold: float = 0.0) -> DataFrame:
    df = cut_lineage(features(df))
    # the label only: this domain keeps no centroid distances
    df = cluster_with_distances(df, CLUSTER_FEATURES, k=k, restarts=restarts, label="cluster")
    df = df.drop(*[c for c in df.columns if c.startswith("Centroid")])
    if not select:
        return df
    df = df.drop(*DROPPED)
    # The reference scores MI with the classification form for this numeric target
    kept, _ = drop_uninformative(df, "mean_exam_points", F.col("Id") <= 9999, ["Id", "mean_exam_points"], threshold)
    return kept
