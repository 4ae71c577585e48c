"""C9 delayed_flight: calendar parts, season/weekend, 365-day calendar and
cyclic features, inferred year and holiday, departure-hour features and
clock bins, route keys, train-only delay rates, distance bins, MI selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import binning as B
from ..functions import columns as C
from ..functions import dates as D
from ..functions import strings as S
from ..operators.groupstats import attach_group_stats
from .common import drop_uninformative

TARGET = "dep_delayed_15min"


def preprocess(df: DataFrame, select: bool = True, threshold: float = 1e-5, reference_compat: bool = False) -> DataFrame:
    df = df.withColumn(TARGET, F.coalesce(C.remap(TARGET, {"N": 0, "Y": 1}, keep_unmatched=False).cast("int"),
                                          F.lit(-1)))
    df = df.withColumns({"Month": S.split_part("Month", "-", 1).cast("int"),
                         "DayofMonth": S.split_part("DayofMonth", "-", 1).cast("int"),
                         "DayOfWeek": S.split_part("DayOfWeek", "-", 1).cast("int")})
    df = df.withColumns({"SeasonType": D.season("Month"), "Weekend": D.is_weekend("DayOfWeek"),
                         "DayInYear": D.day_of_year_365("Month", "DayofMonth")})
    sin_d, cos_d = D.cyclic("DayInYear", 365.0)
    year = D.infer_year("DayInYear", "DayOfWeek")
    df = df.withColumns({"DIYSin": sin_d, "DIYCos": cos_d, "__year": year,
                         "Year": F.concat(F.lit("Y"), year.cast("string"))})
    df = df.withColumn("HolidayType", D.holiday_name("__year", "Month", "DayofMonth")).drop("__year")
    df = df.withColumn("IsHoliday", (F.col("HolidayType") != D.NON_HOLIDAY).cast("int"))

    hour = D.hhmm_to_hour("DepTime")
    sin_h, cos_h = D.cyclic(hour, 24.0)
    t = F.col("DepTime")
    df = df.withColumns({"DepHour": hour, "HourSin": sin_h, "HourCos": cos_h, "HourS": hour * hour,
                         "DepTimeBin": B.ladder(t, [600, 900, 1200, 1500, 1800, 2100, 2400],
                                                ["vem", "m", "mm", "maf", "af", "n", "nn"], "lm")})
    df = df.drop("DepTime", "DayInYear")

    route = S.concat_keys("Origin", "Dest", sep="")
    if reference_compat:  # K3: both carrier keys overwritten with the route
        carrier_origin = carrier_dest = route
    else:
        carrier_origin = S.concat_keys("UniqueCarrier", "Origin", sep="")
        carrier_dest = S.concat_keys("UniqueCarrier", "Dest", sep="")
    df = df.withColumns({"Route": route, "CarrierOrigin": carrier_origin, "CarrierDest": carrier_dest,
                         "DepHourDest": S.concat_keys("DepHour", "Dest"),
                         "DepHourOrigin": S.concat_keys("DepHour", "Origin"),
                         "DepHourCarrier": S.concat_keys("DepHour", "UniqueCarrier"),
                         "DestDepHourCarrier": S.concat_keys("Dest", "DepHour", "UniqueCarrier")}).drop("DepHour")
    known = F.col(TARGET) != -1
    df = attach_group_stats(df, ["Origin", "Dest", "UniqueCarrier"], TARGET, "rate",
                            ["OriginDelayRate", "DestDelayRate", "CarrierDelayRate"], where=known)

    dist = F.col("Distance")
    df = df.withColumns({"DistanceS": dist * dist,
                         "DistBin": B.ladder(dist, [500, 1000, 1500, 2000, 2500],
                                             ["very short", "short", "mid", "midlong", "long"], "very long")})
    df = df.withColumn("HourDist", F.col("HourS") * F.col("DistanceS")).drop("Distance")
    if not select:
        return df
    kept, _ = drop_uninformative(df, TARGET, known, ["id", TARGET], threshold)
    return kept
