"""C10 calories: stack the renamed second source, numeric sweep, log target,
body and heart-rate features with right-closed bins and the intensity
multiplier ladder, ratio to the global BMR median, MI selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import binning as B
from ..functions import columns as C
from ..operators.groupstats import global_stat
from ..sources.io import stack_renamed
from .common import drop_uninformative


def preprocess(first: DataFrame, second: DataFrame | None = None, select: bool = True, threshold: float = 0.0,
               reference_compat: bool = False) -> DataFrame:
    df = first
    if second is not None:
        df = stack_renamed(first, second, {"User_ID": "id", "Gender": "Sex"})
    df = C.cast_numeric(df, fill=0.0)
    df = df.withColumn("Calories", C.log1p("Calories"))
    w, h, age, hr = F.col("Weight"), F.col("Height"), F.col("Age"), F.col("Heart_Rate")
    df = df.withColumns({"BMI": F.try_divide(w, (h / 100.0) * (h / 100.0)),
                         "BSA": 0.007184 * F.pow(w, 0.425) * F.pow(h, 0.725),
                         "Max_Heart_Rate": 211 - 0.64 * age})
    bmr = 10 * w + 6.25 * h - 5 * age
    # K2: the reference compares the text sex with 0, so every row gets the +5 form
    female = F.lit(False) if reference_compat else (F.lower(F.col("Sex")) == "female")
    df = df.withColumns({"BMI_Category": B.cut_right("BMI", [0, 18.5, 24.9, 29.9, 100],
                                                     ["Underweight", "Normal", "Overweight", "Obese"]),
                         "BMR": F.when(female, bmr - 161).otherwise(bmr + 5),
                         "Intensity": F.try_divide(hr, F.col("Max_Heart_Rate"))})
    df = df.withColumns({
        "HR_Zone": B.cut_right("Intensity", [0, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0],
                               ["Very Light", "Light", "Moderate", "Hard", "Very Hard", "Max"]),
        "HR_Duration": hr * F.col("Duration"), "HR_Weight": hr * w,
        "HR_Duration_Weight": hr * F.col("Duration") * w,
        "Body_Strain_Index": F.try_divide(hr * F.col("Body_Temp"), w),
        "TDEE": F.col("BMR") * B.band("Intensity", [(0.5, 0.6, 1.2), (0.6, 0.7, 1.375), (0.7, 0.8, 1.55),
                                                    (0.8, 0.9, 1.725)], 1.9, closed="left")})
    bmr_median = global_stat(df, "BMR", "median")
    df = df.withColumns({"Metabolic_Efficiency": F.col("BMR") * (hr / F.lit(bmr_median)),
                         "Thermic_Effect": F.try_divide(F.col("Body_Temp") * 100, F.sqrt(w)),
                         "Power_Output": w * F.col("Duration") * (hr / 1000)})
    df = df.withColumn("Work_Done", F.col("Power_Output") * F.col("Duration"))
    if not select:
        return df
    # train rows: id < 750000 or id > 5000000 (id 5000000 itself belongs to neither part, K17)
    known = (F.col("id") < 750000) | (F.col("id") > 5000000)
    kept, _ = drop_uninformative(df, "Calories", known, ["id", "Calories"], threshold, target_discrete=False)
    return kept
