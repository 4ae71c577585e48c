"""C2 housing: clean, ordinal levels, median / "None" fills, age, area,
quality (with a random-forest fill of missing overall quality), basement,
porch and bath features, k-means with distances, MI selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..core import cut_lineage
from ..functions import binning as B
from ..functions import columns as C
from ..functions.dates import elapsed_years
from ..operators.cluster import cluster_with_distances
from ..operators.encode import OneHotTimes
from ..operators.groupstats import attach_group_stat
from ..operators.impute import GlobalImputer, ModelImputer, fill_constant, fill_from_column
from .common import drop_uninformative

TARGET = "SalePrice"
RENAMES = {"1stFlrSF": "FirstFlrSF", "2ndFlrSF": "SecondFlrSF", "3SsnPorch": "Threeseasonporch",
           "FireplaceQu": "FireplaceQual"}

# Declared ordinal levels (lowest first).
FIVE_LEVELS = ["Po", "Fa", "TA", "Gd", "Ex"]
ORDERED_LEVELS = {
    "ExterQual": FIVE_LEVELS, "ExterCond": FIVE_LEVELS, "BsmtQual": FIVE_LEVELS, "BsmtCond": FIVE_LEVELS,
    "HeatingQC": FIVE_LEVELS, "KitchenQual": FIVE_LEVELS, "FireplaceQual": FIVE_LEVELS, "GarageQual": FIVE_LEVELS,
    "GarageCond": FIVE_LEVELS, "PoolQC": FIVE_LEVELS,
    "LotShape": ["Reg", "IR1", "IR2", "IR3"], "LandSlope": ["Sev", "Mod", "Gtl"],
    "BsmtExposure": ["No", "Mn", "Av", "Gd"],
    "BsmtFinType1": ["Unf", "LwQ", "Rec", "BLQ", "ALQ", "GLQ"], "BsmtFinType2": ["Unf", "LwQ", "Rec", "BLQ", "ALQ", "GLQ"],
    "Functional": ["Sal", "Sev", "Maj1", "Maj2", "Mod", "Min2", "Min1", "Typ"],
    "GarageFinish": ["Unf", "RFn", "Fin"], "PavedDrive": ["N", "P", "Y"], "Utilities": ["NoSeWa", "NoSewr", "AllPub"],
    "CentralAir": ["N", "Y"], "Electrical": ["Mix", "FuseP", "FuseF", "FuseA", "SBrkr"],
    "Fence": ["MnWw", "GdWo", "MnPrv", "GdPrv"],
}
QUALITY_SCORE = {"Ex": 5, "Gd": 4, "TA": 3, "Fa": 2, "Po": 1}
BASEMENT_SCORE = {"NA": 0, "Po": 1, "Fa": 2, "TA": 3, "Gd": 4, "Ex": 5}
PORCHES = ["WoodDeckSF", "OpenPorchSF", "EnclosedPorch", "Threeseasonporch", "ScreenPorch"]
CLUSTER_FEATURES = ["LotArea", "TotalBsmtSF", "FirstFlrSF", "SecondFlrSF", "GrLivArea"]


def clean_encode_impute(df: DataFrame, reference_compat: bool = False) -> DataFrame:
    df = df.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in df.columns})
    df = df.withColumn("Exterior2nd", C.remap("Exterior2nd", {"Brk Cmn": "BrkComm"}))
    # K6: a NULL garage year fails "<= 2010" and takes the build year too
    df = df.withColumn("GarageYrBlt", fill_from_column("GarageYrBlt", "YearBuilt", F.col("GarageYrBlt") <= 2010))
    # unlisted levels become NULL, then "None" with the other categorical gaps
    df = df.withColumns({c: F.when(F.col(c).isin(lv), F.col(c)) for c, lv in ORDERED_LEVELS.items()
                         if c in df.columns})
    quality_levels = list(range(0, 10)) if reference_compat else list(range(1, 11))  # K4
    df = df.withColumns({c: F.when(F.col(c).isin(quality_levels), F.col(c)) for c in ("OverallQual", "OverallCond")})
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    df = fill_constant(df, {c: "None" for c in text})
    # K5: the target is never imputed; overall quality is filled by a model below
    return GlobalImputer(None, "median", exclude=["Id", TARGET, "OverallQual"]).fit(df).transform(df)


def preprocess(df: DataFrame, k: int = 20, restarts: int = 50, num_trees: int = 100, select: bool = True,
               threshold: float = 1e-5, reference_compat: bool = False) -> DataFrame:
    df = cut_lineage(clean_encode_impute(df, reference_compat))
    df = df.withColumns({"HouseAge": elapsed_years("YrSold", "YearBuilt"),
                         "HouseRemodAge": elapsed_years("YrSold", "YearRemodAdd"),
                         "GarageAge": F.col("YrSold") - F.col("GarageYrBlt")})
    df = df.withColumn("HouseCond", B.round_cap("HouseAge", 20, 4).cast("int"))

    g = F.col("GrLivArea")
    df = df.withColumns({"TotalArea": g + F.col("TotalBsmtSF"),
                         "TotalSF": F.col("FirstFlrSF") + F.col("SecondFlrSF") + F.col("BsmtFinSF1")
                         + F.col("BsmtFinSF2")})
    df = df.withColumns({"LivAreaRatio": F.try_divide(g, F.col("TotalSF")),
                         "LivLotRatio": F.try_divide(g, F.col("LotArea")),
                         "RmsPerSqft": F.try_divide(F.col("TotRmsAbvGrd"), g),
                         "BedroomRatio": F.try_divide(F.col("BedroomAbvGr"), g),
                         "FlrRatio": F.try_divide(F.col("FirstFlrSF"), F.col("FirstFlrSF") + F.col("SecondFlrSF")),
                         "Spaciousness": F.try_divide(F.col("FirstFlrSF") + F.col("SecondFlrSF"),
                                                      F.col("TotRmsAbvGrd")),
                         "LgGrLivArea": C.log1p(g), "LgMasVnrArea": C.log1p("MasVnrArea")})
    df = OneHotTimes("BldgType", "GrLivArea", "Bldg").fit(df).transform(df)
    df = cut_lineage(attach_group_stat(df, ["Neighborhood"], "GrLivArea", "median", "MedNhbdArea"))

    df = ModelImputer("OverallQual", ["ExterQual", "BsmtQual", "KitchenQual", "Neighborhood"],
                      ["GrLivArea", "GarageArea", "YearBuilt", "YearRemodAdd"], num_trees=num_trees, seed=42) \
        .fit(df).transform(df)
    df = df.withColumns({"OverallAvg": F.bround((F.col("OverallQual") + F.col("OverallCond")) / 2, 0).cast("int"),
                         "QualSF": F.col("TotalSF") * F.col("OverallQual")})
    df = attach_group_stat(df, ["Neighborhood"], "OverallQual", "median", "NhbQual")
    quality = ["ExterQual", "KitchenQual", "BsmtQual", "FireplaceQual", "GarageQual"]
    df = df.withColumns({q + "Num": C.remap(F.trim(q), QUALITY_SCORE, keep_unmatched=False) for q in quality})
    df = GlobalImputer([q + "Num" for q in quality], "median").fit(df).transform(df)
    df = cut_lineage(df.withColumn("CompositeQual", C.row_mean([q + "Num" for q in quality])))

    df = df.withColumns({"BsmtQualNum": F.coalesce(C.remap("BsmtQual", BASEMENT_SCORE, False), F.lit(0)),
                         "BsmtCondNum": F.coalesce(C.remap("BsmtCond", BASEMENT_SCORE, False), F.lit(0))})
    df = df.withColumn("BsmtQualityScore", F.bround((F.col("BsmtQualNum") + F.col("BsmtCondNum")) / 2.0, 0)
                       .cast("int"))
    df = df.withColumn("PorchTypes", C.count_positive(PORCHES))
    df = df.withColumn("TotalBath", F.col("FullBath") + 0.5 * F.col("HalfBath") + F.col("BsmtFullBath")
                       + 0.5 * F.col("BsmtHalfBath"))
    df = cluster_with_distances(df, CLUSTER_FEATURES, k=k, restarts=restarts)
    if not select:
        return df
    kept, _ = drop_uninformative(df, TARGET, F.col(TARGET).isNotNull(), ["Id", TARGET], threshold,
                                 target_discrete=False)
    return kept
