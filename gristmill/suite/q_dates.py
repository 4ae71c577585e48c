"""Date and time queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators.groupstats import days_since_first as days_since
from ..operators.groupstats import dense_rank_in_group as dense_rank
from .inputs import T as tbl
from .registry import register


@register("date_parts", sql="""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(day(o_orderdate) AS INTEGER) AS day, CAST(o_orderdate AS DATE) AS date FROM orders""")
def date_parts(spark, d):
    o = tbl(spark, d, "orders")
    return o.select("o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
                    F.dayofmonth("o_orderdate").alias("day"), F.to_date("o_orderdate").alias("date"))


@register("days_since_first", sql="""
WITH f AS (SELECT o_custkey, min(o_orderdate) AS first FROM orders GROUP BY o_custkey),
a AS (SELECT o_orderkey, CAST(date_diff('day', CAST(first AS DATE), CAST(o_orderdate AS DATE)) AS INTEGER) AS days
      FROM orders JOIN f USING (o_custkey))
SELECT o_orderkey, days, CAST(round_even(days / 30.0, 3) AS DOUBLE) AS months,
       CAST(round_even(round_even(days / 30.0, 3) / 12.0, 3) AS DOUBLE) AS years FROM a""")
def days_since_first(spark, d):
    o = days_since(tbl(spark, d, "orders"), ["o_custkey"], "o_orderdate", "days")
    months = F.bround(F.col("days") / 30.0, 3)
    return o.select("o_orderkey", "days", months.alias("months"), F.bround(months / 12.0, 3).alias("years"))


@register("dense_rank_in_group", sql="""
SELECT o_orderkey, CAST(dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS BIGINT) AS listing_num
FROM orders""")
def dense_rank_in_group(spark, d):
    o = tbl(spark, d, "orders")
    return dense_rank(o, ["o_custkey"], "o_orderdate", "listing_num").select("o_orderkey", "listing_num")


@register("elapsed_years", sql="""
SELECT o_orderkey, greatest(1998 - CAST(year(o_orderdate) AS INTEGER), 0) AS age_years FROM orders""")
def elapsed_years(spark, d):
    o = tbl(spark, d, "orders")
    return o.select("o_orderkey", D.elapsed_years(F.lit(1998), F.year("o_orderdate")).alias("age_years"))


@register("weekend_flag", sql="""
SELECT o_orderkey, CAST(isodow(o_orderdate) AS INTEGER) AS dow, CAST(isodow(o_orderdate) > 5 AS INTEGER) AS weekend
FROM orders""")
def weekend_flag(spark, d):
    o = tbl(spark, d, "orders")
    dow = F.weekday("o_orderdate") + 1
    return o.select("o_orderkey", dow.alias("dow"), D.is_weekend(dow).alias("weekend"))


_DOY_SQL = ("(CASE month(o_orderdate) " + " ".join(
    f"WHEN {m} THEN {sum(D.DAYS_IN_MONTH[:m - 1])}" for m in range(1, 13)) + " END + day(o_orderdate))")


@register("day_of_year_365", sql=f"""
SELECT o_orderkey, CAST({_DOY_SQL} AS INTEGER) AS day_in_year FROM orders""")
def day_of_year_365(spark, d):
    o = tbl(spark, d, "orders")
    return o.select("o_orderkey", D.day_of_year_365(F.month("o_orderdate"), F.dayofmonth("o_orderdate"))
                    .alias("day_in_year"))


@register("cyclic_time", sql=f"""
SELECT o_orderkey, round(sin(2 * pi() * {_DOY_SQL} / 365.0), 6) AS diy_sin,
       round(cos(2 * pi() * {_DOY_SQL} / 365.0), 6) AS diy_cos FROM orders""")
def cyclic_time(spark, d):
    o = tbl(spark, d, "orders")
    s, c = D.cyclic(D.day_of_year_365(F.month("o_orderdate"), F.dayofmonth("o_orderdate")), 365.0)
    return o.select("o_orderkey", F.round(s, 6).alias("diy_sin"), F.round(c, 6).alias("diy_cos"))


@register("infer_year", sql=f"""
SELECT o_orderkey, CAST(2018 - ((({_DOY_SQL} - isodow(o_orderdate)) % 7) + 7) % 7 AS INTEGER) AS year_guess
FROM orders""")
def infer_year(spark, d):
    o = tbl(spark, d, "orders")
    doy = D.day_of_year_365(F.month("o_orderdate"), F.dayofmonth("o_orderdate"))
    return o.select("o_orderkey", D.infer_year(doy, F.weekday("o_orderdate") + 1).cast("int").alias("year_guess"))


@register("hhmm_to_hour", sql="""
WITH a AS (SELECT event_id, hour(ts) * 100 + minute(ts) AS t FROM events),
b AS (SELECT event_id, (((floor(t / 100)) % 24) + 24) % 24 + ((t % 100 + 100) % 100) / 60.0 AS h FROM a)
SELECT event_id, round(h, 6) AS dep_hour, round(h * h, 6) AS hour_sq,
       round(sin(2 * pi() * h / 24.0), 6) AS hour_sin, round(cos(2 * pi() * h / 24.0), 6) AS hour_cos FROM b""")
def hhmm_to_hour(spark, d):
    e = tbl(spark, d, "events")
    h = D.hhmm_to_hour(F.hour("ts") * 100 + F.minute("ts"))
    s, c = D.cyclic(h, 24.0)
    return e.select("event_id", F.round(h, 6).alias("dep_hour"), F.round(h * h, 6).alias("hour_sq"),
                    F.round(s, 6).alias("hour_sin"), F.round(c, 6).alias("hour_cos"))


_HOLIDAY_SQL = """CASE
  WHEN month(o_orderdate) = 1 AND day(o_orderdate) = 1 THEN 'New Year''s Day'
  WHEN month(o_orderdate) = 7 AND day(o_orderdate) = 4 THEN 'Independence Day'
  WHEN month(o_orderdate) = 11 AND day(o_orderdate) = 11 THEN 'Veterans Day'
  WHEN month(o_orderdate) = 12 AND day(o_orderdate) = 25 THEN 'Christmas Day'
  WHEN month(o_orderdate) = 1 AND dayofweek(o_orderdate) = 1 AND day(o_orderdate) BETWEEN 15 AND 21 THEN 'MLK Jr. Day'
  WHEN month(o_orderdate) = 2 AND dayofweek(o_orderdate) = 1 AND day(o_orderdate) BETWEEN 15 AND 21 THEN 'Presidents'' Day'
  WHEN month(o_orderdate) = 5 AND dayofweek(o_orderdate) = 1 AND day(o_orderdate) >= 25 THEN 'Memorial Day'
  WHEN month(o_orderdate) = 9 AND dayofweek(o_orderdate) = 1 AND day(o_orderdate) <= 7 THEN 'Labor Day'
  WHEN month(o_orderdate) = 10 AND dayofweek(o_orderdate) = 1 AND day(o_orderdate) BETWEEN 8 AND 14 THEN 'Columbus Day'
  WHEN month(o_orderdate) = 11 AND dayofweek(o_orderdate) = 4 AND day(o_orderdate) BETWEEN 22 AND 28
       THEN 'Thanksgiving Day'
  ELSE 'Non-Holiday' END"""


@register("holiday_flag", sql=f"""
WITH a AS (SELECT o_orderkey, {_HOLIDAY_SQL} AS holiday FROM orders)
SELECT o_orderkey, holiday, CAST(holiday <> 'Non-Holiday' AS INTEGER) AS is_holiday FROM a""")
def holiday_flag(spark, d):
    o = tbl(spark, d, "orders")
    name = D.holiday_name(F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate"))
    return o.select("o_orderkey", name.alias("holiday"), (name != D.NON_HOLIDAY).cast("int").alias("is_holiday"))
