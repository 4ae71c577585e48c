"""C1 titanic: title rules, title-mean age fill, family and ticket features,
class-mean fare fill, cabin parse, embarked mode fill."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..core import cut_lineage
from ..functions import columns as C
from ..functions import strings as S
from ..operators.impute import GlobalImputer, GroupImputer, impute_category_mean_rounded

# Title pattern and title groups of the passenger-name rules.
TITLE_PATTERN = r",\s*(Mrs|Mr|Master|Miss|Don|Rev|Dr|Ms|Major|Lady|Sir|Col|Mme|Mlle|Capt|the Countess|Jonkheer)"
MALE_TITLES = ["Don", "Rev", "Dr", "Major", "Sir", "Col", "Capt", "Jonkheer"]
FEMALE_TITLES = ["Lady", "Ms", "Mme", "Mlle", "the Countess"]
AGE_TITLES = ["Mr", "Mrs", "Master", "Miss"]
DEFAULT_AGE = 28.0


def preprocess(df: DataFrame) -> DataFrame:
    title = S.extract_first("Name", TITLE_PATTERN)
    title = F.when(title.isin(MALE_TITLES), "Mr").when(title.isin(FEMALE_TITLES), "Mrs").otherwise(title)
    df = df.withColumn("Title", title)
    child_title = F.coalesce(F.col("Title").isin("Master", "Miss"), F.lit(False))
    df = df.withColumn("IsAdult", C.rule_flag_with_fallback("Age", 21, ~child_title))
    t = F.col("Title")
    for src, adult, dst in [("Miss", 1, "Mrs"), ("Mrs", 0, "Miss"), ("Master", 1, "Mr"), ("Mr", 0, "Master")]:
        t = F.when((t == src) & (F.col("IsAdult") == adult), F.lit(dst)).otherwise(t)
    df = df.withColumn("Title", t)

    # age: mean of the title's known ages, floored (+0.5 for male titles), else 28
    df = df.withColumn("__t", F.when(F.col("Title").isin(AGE_TITLES), F.col("Title")))
    df = cut_lineage(impute_category_mean_rounded(df, "Age", "__t", ["Mr", "Master"], DEFAULT_AGE).drop("__t"))

    df = df.withColumn("Sex", C.remap(F.lower("Sex"), {"male": 1, "female": 0}, keep_unmatched=False))
    df = df.withColumn("FamSize", F.col("SibSp") + F.col("Parch") + 1)
    df = df.withColumn("hasNanny", (F.col("Title").isin("Master", "Miss") & (F.col("FamSize") == 1)).cast("int"))
    df = df.withColumns({"TicketLetter": S.first_token_or("Ticket", "No"),
                         "TicketNumber": S.last_token_or("Ticket", "0")})

    df = df.withColumn("Fare", F.when(F.col("Fare") == 0, F.lit(1.0)).otherwise(F.col("Fare")))
    df = GroupImputer("Fare", ["Pclass"], "mean").fit(df).transform(df)

    letter, number = S.code_list_letter_number(F.coalesce("Cabin", F.lit("No")), missing="No")
    df = df.withColumns({"CabinLet": letter, "CabinNum": number})
    df = GlobalImputer(["Embarked"], "mode").fit(df).transform(df)
    return df.drop("Name", "Ticket", "Cabin")
