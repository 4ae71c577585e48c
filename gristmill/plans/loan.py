"""C6 loan: constant fills, home-ownership categories, group-median fills,
quartile groups, log and ratio features, job-years parse, credit bins,
k-means with distances, MI selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..core import cut_lineage
from ..functions import binning as B
from ..functions import columns as C
from ..functions import strings as S
from ..operators.cluster import cluster_with_distances
from ..operators.impute import GroupImputer, fill_constant
from ..operators.quantile import global_quantiles
from .common import drop_uninformative

HOME = "Home Ownership"


def _c(name):
    return F.col(f"`{name}`")


def _qcut(df, column, labels):
    edges = global_quantiles(df, _c(column), [i / 4 for i in range(5)])
    if len(set(edges)) != len(edges):
        raise ValueError(f"quantile edges of {column} are not unique: {edges}")
    return B.cut_right(_c(column), edges, labels, include_lowest=True)


def features(df: DataFrame) -> DataFrame:
    """The deterministic features, before clusters."""
    df = fill_constant(df, {"Years in current job": "None", "Purpose": "None", "Term": "None",
                            "Months since last delinquent": 0.0, "Bankruptcies": 0.0})
    df = df.withColumn("Credit Default", F.coalesce(_c("Credit Default"), F.lit(0)))
    df = df.withColumn(HOME, C.categorise_by_substring(_c(HOME), [("Rent", "Rent"), ("Mortgage", "Mortgage")], "Home"))
    df = df.withColumn("hasHome", (_c(HOME) == "Home").cast("int"))

    df = GroupImputer("Annual Income", [HOME], "median").fit(df).transform(df)
    df = df.withColumn("Monthly Income", _c("Annual Income") / 12.0)
    df = df.withColumn("Income Group", _qcut(df, "Annual Income", ["Low", "Medium", "High", "Very High"]))
    df = df.withColumns({"Log Annual Income": C.log1p(_c("Annual Income")),
                         "Log Monthly Income": C.log1p(_c("Monthly Income")),
                         "Log Monthly Debt": C.log1p(_c("Monthly Debt")),
                         "Income after Debt": _c("Monthly Income") - _c("Monthly Debt"),
                         "Dept Income Ratio": F.try_divide(_c("Monthly Debt"), _c("Monthly Income"))})
    df = df.withColumn("Years in current job", S.phrase_to_number(_c("Years in current job")))
    df = cut_lineage(GroupImputer("Years in current job", [HOME], "median").fit(df).transform(df))

    df = df.withColumns({"Has Liens": C.flag(_c("Tax Liens") > 0),
                         "Has Problems": C.flag(_c("Number of Credit Problems") > 0),
                         "Bankrupted": C.flag(_c("Bankruptcies") > 0),
                         "Log Maximum Open Credit": C.log1p(_c("Maximum Open Credit")),
                         "Log Current Loan Amount": C.log1p(_c("Current Loan Amount")),
                         "Log Current Credit Balance": C.log1p(_c("Current Credit Balance")),
                         "Year since last delinquent": _c("Months since last delinquent") / 12.0,
                         "No delinquent": C.flag(_c("Months since last delinquent") == 0),
                         "Months of Credit History": _c("Years of Credit History") * 12,
                         "Credit History Group": B.cut_right(_c("Years of Credit History"), [0, 5, 10, 20, 50],
                                                             ["Very Short", "Short", "Medium", "Long"])})
    df = GroupImputer("Credit Score", [HOME], "median").fit(df).transform(df)
    df = df.withColumns({"Log Credit Score": C.log1p(_c("Credit Score")),
                         "Debt Score Interaction": _c("Dept Income Ratio") * _c("Credit Score")})
    return df.withColumn("Credit Score Group", _qcut(df, "Credit Score", ["Bad", "Average", "Good", "Excellent"]))


def preprocess(df: DataFrame, k: int = 10, restarts: int = 50, select: bool = True, threshold: float = 0.0) -> DataFrame:
    df = cut_lineage(features(df))
    feats = ["Log Monthly Income", "Log Credit Score", "Debt Score Interaction", "Log Current Loan Amount",
             "Log Maximum Open Credit"]
    df = cluster_with_distances(df, feats, k=k, restarts=restarts)
    if not select:
        return df
    kept, _ = drop_uninformative(df, "Credit Default", F.col("Id") <= 7499, ["Id", "Credit Default"], threshold)
    return kept
