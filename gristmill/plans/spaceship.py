"""C3 spaceship: id/name/cabin splits, cascaded mode and age fills, activity
rules for sleep status and spending, bill features, k-means with distances."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..core import cut_lineage
from ..functions import columns as C
from ..functions import strings as S
from ..operators.cluster import cluster_with_distances
from ..operators.encode import OneHotTimes
from ..operators.impute import GlobalImputer, fill_groups, flag_from_threshold, impute_cascade

# Planet and destination codes.
HOME_CODES = {"Earth": 1, "Europa": 2, "Mars": 3}
DEST_CODES = {"TRAPPIST-1e": 1, "PSO J318.5-22": 2, "55 Cancri e": 3}
SERVICES = ["RoomService", "FoodCourt", "ShoppingMall", "Spa", "VRDeck"]


def preprocess(df: DataFrame, k: int = 10, restarts: int = 50, reference_compat: bool = False) -> DataFrame:
    df = df.withColumn("Transported", F.coalesce(F.col("Transported").cast("int"), F.lit(-1)))
    df = df.withColumns({"HomePlanet": C.remap("HomePlanet", HOME_CODES).cast("int"),
                         "Destination": C.remap("Destination", DEST_CODES).cast("int")})
    df = df.withColumns({"Group": S.split_part("PassengerId", "_", 0).cast("int"),
                         "NumInGroup": S.split_part("PassengerId", "_", 1).cast("int")})
    for c in ("HomePlanet", "Destination"):
        df = impute_cascade(df, c, [(["Group"], "mode"), ([], "mode")])
    df = cut_lineage(df)

    df = df.withColumns({"FirstName": F.coalesce(S.split_part("Name", " ", 0), F.lit("None")),
                         "LastName": F.coalesce(S.split_part("Name", " ", 1), F.lit("None"))})
    df = df.withColumns({"DeckCab": S.split_part("Cabin", "/", 0), "NumCab": S.split_part("Cabin", "/", 1),
                         "SideCab": S.split_part("Cabin", "/", 2)})
    df = GlobalImputer(["DeckCab", "NumCab", "SideCab"], "mode").fit(df).transform(df)
    df = df.withColumn("Cabin", F.concat_ws("/", "DeckCab", "NumCab", "SideCab"))

    # age: group median, then (after that fill) the planet's mean truncated to int
    df = cut_lineage(impute_cascade(df, "Age", [(["Group"], "median"), (["HomePlanet"], "mean", "long")]))

    if reference_compat:  # K7: booleans compared with "TRUE"/"FALSE" text are all unmatched
        df = df.withColumns({"CryoSleep": F.lit(None).cast("int"), "VIP": F.lit(None).cast("int")})
    else:
        df = df.withColumns({"CryoSleep": F.col("CryoSleep").cast("int"), "VIP": F.col("VIP").cast("int")})
    df = df.withColumn("Active", C.any_positive(SERVICES))
    df = df.withColumn("CryoSleep", F.coalesce(F.col("CryoSleep"), F.when(F.col("Active"), 0).otherwise(1)))
    df = df.withColumns({s: F.when(F.col(s).isNull() & (F.col("CryoSleep") == 1), F.lit(0.0)).otherwise(F.col(s))
                         for s in SERVICES})
    df = cut_lineage(fill_groups(df, SERVICES, ["CryoSleep"], "median"))
    df = df.withColumn("TotalBill", sum((F.col(s) for s in SERVICES), F.lit(0.0)))
    df = flag_from_threshold(df, "VIP", "TotalBill")
    df = OneHotTimes("Destination", "TotalBill", "Hp").fit(df).transform(df)
    df = cluster_with_distances(df, ["VRDeck", "Spa", "ShoppingMall", "FoodCourt", "RoomService", "TotalBill"],
                                k=k, restarts=restarts)
    return df.drop("Name", "Active")
