"""Domain plans (C1, C4, C6-C10) over derived columns of the given tables: the
deterministic part of each, with its oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import calories, delayed_flight, loan, math_exam, math_prob, molecular, titanic
from .inputs import T as tbl, wide
from .q_dates import _HOLIDAY_SQL
from .q_text import _clean_sql, _tokens_sql
from .registry import register


def _rounded(df, key: str, numbers: list[str], texts: list[str] = ()):
    """The key, numbers as doubles rounded to 6 places, and texts; blanks in names become underscores."""
    return df.select(F.col(f"`{key}`").cast("long").alias(key.lower()),
                     *[F.round(F.col(f"`{c}`").cast("double"), 6).alias(c.replace(" ", "_")) for c in numbers],
                     *[F.col(f"`{c}`").alias(c.replace(" ", "_")) for c in texts])


def _round_sql(exprs: dict[str, str]) -> str:
    return ", ".join(f"round(CAST({e} AS DOUBLE), 6) AS {n}" for n, e in exprs.items())


# ---- C10 -------------------------------------------------------------------------------

_BODY = """o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'female' ELSE 'male' END AS Sex,
  CAST(20 + o_orderkey % 50 AS DOUBLE) AS Age, CAST(150 + o_custkey % 50 AS DOUBLE) AS Height,
  CAST(50 + o_orderkey * 7 % 60 AS DOUBLE) AS Weight, CAST(1 + o_orderkey % 30 AS DOUBLE) AS Duration,
  CAST(80 + o_custkey % 60 AS DOUBLE) AS Heart_Rate, CAST(37 + o_orderkey % 4 AS DOUBLE) AS Body_Temp,
  o_totalprice AS Calories"""
_BODY_OUT = {
    "Calories": "ln(1 + Calories)", "BMI": "bmi", "BSA": "0.007184 * pow(Weight, 0.425) * pow(Height, 0.725)", "BMR": "bmr",
    "Intensity": "intensity", "HR_Duration_Weight": "Heart_Rate * Duration * Weight", "Body_Strain_Index": "Heart_Rate * Body_Temp / Weight",
    "TDEE": """bmr * CASE WHEN intensity >= 0.5 AND intensity < 0.6 THEN 1.2 WHEN intensity >= 0.6 AND intensity < 0.7 THEN 1.375
      WHEN intensity >= 0.7 AND intensity < 0.8 THEN 1.55 WHEN intensity >= 0.8 AND intensity < 0.9 THEN 1.725 ELSE 1.9 END""",
    "Metabolic_Efficiency": "bmr * (Heart_Rate / m)", "Thermic_Effect": "Body_Temp * 100 / sqrt(Weight)",
    "Work_Done": "Weight * Duration * (Heart_Rate / 1000) * Duration"}


@register("plan_calories", sql=f"""
WITH s AS (SELECT {_BODY} FROM orders),
a AS (SELECT *, Weight / ((Height / 100) * (Height / 100)) AS bmi, Heart_Rate / (211 - CAST(0.64 AS DOUBLE) * Age) AS intensity,
  10 * Weight + 6.25 * Height - 5 * Age + CASE WHEN Sex = 'female' THEN -161 ELSE 5 END AS bmr FROM s),
q AS (SELECT median(bmr) AS m FROM a)
SELECT id, {_round_sql(_BODY_OUT)},
  CASE WHEN bmi > 0 AND bmi <= 18.5 THEN 'Underweight' WHEN bmi > 18.5 AND bmi <= 24.9 THEN 'Normal'
       WHEN bmi > 24.9 AND bmi <= 29.9 THEN 'Overweight' WHEN bmi > 29.9 AND bmi <= 100 THEN 'Obese' END AS BMI_Category,
  CASE WHEN intensity <= 0 THEN NULL WHEN intensity <= 0.5 THEN 'Very Light' WHEN intensity <= 0.6 THEN 'Light'
       WHEN intensity <= 0.7 THEN 'Moderate' WHEN intensity <= 0.8 THEN 'Hard' WHEN intensity <= 0.9 THEN 'Very Hard'
       WHEN intensity <= 1 THEN 'Max' END AS HR_Zone
FROM a CROSS JOIN q""")
def plan_calories(spark, d):
    body = tbl(spark, d, "orders").selectExpr(*_columns(_BODY))
    return _rounded(calories.preprocess(body, select=False), "id", list(_BODY_OUT), ["BMI_Category", "HR_Zone"])


def _columns(sql: str) -> list[str]:
    """The select list of a derived input, one expression each (commas inside brackets stay)."""
    out, depth, part = [], 0, ""
    for c in sql:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(part)
            part = ""
        else:
            part += c
    return [*out, part]


# ---- C8 --------------------------------------------------------------------------------

_EXAM = """o_orderkey AS Id, CAST(20 + o_orderkey % 45 AS DOUBLE) AS age, CAST(o_custkey % 12 AS DOUBLE) AS years_of_experience,
  CAST(round(o_totalprice / 100) AS DOUBLE) AS lesson_price, CAST(1 + o_orderkey % 4 AS DOUBLE) AS qualification,
  CAST(o_custkey % 2 AS DOUBLE) AS physics, CAST(o_custkey % 3 % 2 AS DOUBLE) AS chemistry,
  CAST(o_custkey % 5 % 2 AS DOUBLE) AS biology, CAST(o_orderkey % 2 AS DOUBLE) AS english,
  CAST(o_orderkey % 3 % 2 AS DOUBLE) AS geography, CAST(o_orderkey % 5 % 2 AS DOUBLE) AS history,
  CASE WHEN o_orderkey % 5 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(30 + o_orderkey % 70 AS DOUBLE) END AS mean_exam_points"""
_EXAM_OUT = {
    "mean_exam_points": "coalesce(mean_exam_points, 0)", "log_age": "ln(age)", "years_of_experience": "years",
    "log_years_of_experience": "ln(1 + years)", "start_tutor": "age - years", "log_month_of_experience": "ln(years * 12)",
    "age_bin": "age_bin", "square_price": "lesson_price * lesson_price", "lesson_age": "lesson_price / avg(lesson_price) OVER (PARTITION BY age_bin)",
    "lesson_experience": "lesson_price / avg(lesson_price) OVER (PARTITION BY years)",
    "lesson_qualification": "lesson_price / avg(lesson_price) OVER (PARTITION BY qualification)",
    "total_subject": "physics + chemistry + biology + english + geography + history", "total_subject_binary": "code",
    "lesson_subject_binary": "lesson_price / avg(lesson_price) OVER (PARTITION BY code)"}


@register("plan_math_exam", sql=f"""
WITH s AS (SELECT {_EXAM} FROM orders),
a AS (SELECT *, CASE WHEN years_of_experience >= 1 THEN years_of_experience ELSE 0.5 END AS years,
  CASE WHEN age <= 20 THEN 1 WHEN age <= 30 THEN 2 WHEN age <= 40 THEN 3 WHEN age <= 50 THEN 4 WHEN age <= 60 THEN 5 ELSE 6 END AS age_bin,
  history + 2 * geography + 4 * english + 8 * biology + 16 * chemistry + 32 * physics AS code FROM s)
SELECT Id AS id, {_round_sql(_EXAM_OUT)} FROM a""")
def plan_math_exam(spark, d):
    exam = tbl(spark, d, "orders").selectExpr(*_columns(_EXAM))
    return _rounded(math_exam.features(exam), "Id", list(_EXAM_OUT))


# ---- C6 --------------------------------------------------------------------------------

_LOAN = {
    "Id": "o_orderkey", "Home Ownership": "CASE o_custkey % 4 WHEN 0 THEN 'Own Home' WHEN 1 THEN 'Rent' WHEN 2 THEN 'Home Mortgage' ELSE 'Have Mortgage' END",
    "Annual Income": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END",
    "Years in current job": "CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '< 1 year' WHEN 2 THEN '10+ years' WHEN 3 THEN '2 years' ELSE '7 years' END",
    "Tax Liens": "CAST(o_orderkey % 3 AS DOUBLE)", "Number of Credit Problems": "CAST(o_custkey % 2 AS DOUBLE)",
    "Years of Credit History": "CAST(o_orderkey % 55 AS DOUBLE)", "Maximum Open Credit": "o_totalprice * 2",
    "Months since last delinquent": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 60 AS DOUBLE) END",
    "Bankruptcies": "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey % 2 AS DOUBLE) END",
    "Purpose": "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END", "Term": "o_orderstatus",
    "Current Loan Amount": "o_totalprice / 2", "Current Credit Balance": "CAST(o_custkey * 10 AS DOUBLE)",
    "Monthly Debt": "CAST(1 + o_custkey % 900 AS DOUBLE)",
    "Credit Score": "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(500 + o_orderkey % 300 AS DOUBLE) END",
    "Credit Default": "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END"}
_LOAN_OUT = {
    "Annual Income": "income", "Log Monthly Income": "ln(1 + income / 12)", "Income after Debt": "income / 12 - debt",
    "Dept Income Ratio": "debt / (income / 12)", "Years in current job": "job", "Credit Score": "score",
    "Debt Score Interaction": "debt / (income / 12) * score", "Has Liens": "CAST(liens > 0 AS INTEGER)",
    "Bankrupted": "CAST(coalesce(broke, 0) > 0 AS INTEGER)", "Year since last delinquent": "coalesce(months, 0) / 12",
    "No delinquent": "CAST(coalesce(months, 0) = 0 AS INTEGER)", "hasHome": "CAST(home = 'Home' AS INTEGER)"}


def _quarters(c: str, q: str, labels: list[str]) -> str:
    return (f"CASE WHEN {c} >= {q}[1] AND {c} <= {q}[2] THEN '{labels[0]}' WHEN {c} > {q}[2] AND {c} <= {q}[3] THEN '{labels[1]}' "
            f"WHEN {c} > {q}[3] AND {c} <= {q}[4] THEN '{labels[2]}' WHEN {c} > {q}[4] AND {c} <= {q}[5] THEN '{labels[3]}' END")


@register("plan_loan", sql=f"""
WITH s AS (SELECT o_orderkey AS id, CASE WHEN o_custkey % 4 = 0 THEN 'Home' WHEN o_custkey % 4 = 1 THEN 'Rent' ELSE 'Mortgage' END AS home,
  {_LOAN["Annual Income"]} AS income0, CASE o_orderkey % 5 WHEN 1 THEN 0.5 WHEN 2 THEN 10.5 WHEN 3 THEN 2.0 WHEN 4 THEN 7.0 END AS job0,
  {_LOAN["Tax Liens"]} AS liens, {_LOAN["Months since last delinquent"]} AS months, {_LOAN["Bankruptcies"]} AS broke,
  {_LOAN["Monthly Debt"]} AS debt, {_LOAN["Credit Score"]} AS score0, {_LOAN["Years of Credit History"]} AS credit,
  coalesce({_LOAN["Purpose"]}, 'None') AS purpose FROM orders),
m AS (SELECT home, median(income0) AS mi, median(CAST(job0 AS DOUBLE)) AS mj, median(score0) AS ms FROM s GROUP BY home),
a AS (SELECT s.*, coalesce(income0, mi) AS income, coalesce(CAST(job0 AS DOUBLE), mj) AS job, coalesce(score0, ms) AS score FROM s JOIN m USING (home)),
q AS (SELECT quantile_cont(income, [0, 0.25, 0.5, 0.75, 1]) AS qi, quantile_cont(score, [0, 0.25, 0.5, 0.75, 1]) AS qs FROM a)
SELECT id, {_round_sql({n.replace(" ", "_"): e for n, e in _LOAN_OUT.items()})}, home AS Home_Ownership, purpose AS Purpose,
  {_quarters("income", "qi", ["Low", "Medium", "High", "Very High"])} AS Income_Group,
  {_quarters("score", "qs", ["Bad", "Average", "Good", "Excellent"])} AS Credit_Score_Group,
  CASE WHEN credit > 0 AND credit <= 5 THEN 'Very Short' WHEN credit > 5 AND credit <= 10 THEN 'Short'
       WHEN credit > 10 AND credit <= 20 THEN 'Medium' WHEN credit > 20 AND credit <= 50 THEN 'Long' END AS Credit_History_Group
FROM a CROSS JOIN q""")
def plan_loan(spark, d):
    loans = tbl(spark, d, "orders").select(*[F.expr(e).alias(n) for n, e in _LOAN.items()])
    return _rounded(loan.features(loans), "Id", list(_LOAN_OUT),
                    ["Home Ownership", "Purpose", "Income Group", "Credit Score Group", "Credit History Group"])


# ---- C9 --------------------------------------------------------------------------------

_FLIGHT = """o_orderkey AS id, concat('c-', month(o_orderdate)) AS Month, concat('c-', day(o_orderdate)) AS DayofMonth,
  concat('c-', 1 + o_orderkey % 7) AS DayOfWeek, CAST((o_orderkey * 37 % 26) * 100 + o_orderkey * 13 % 60 AS INTEGER) AS DepTime,
  substr(o_orderpriority, 3, 3) AS UniqueCarrier, concat('A', 10 + o_custkey % 20) AS Origin, concat('B', 10 + o_orderkey % 20) AS Dest,
  CAST(o_custkey % 3000 AS INTEGER) AS Distance,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS dep_delayed_15min"""
_FLIGHT_OUT = {
    "dep_delayed_15min": "y", "Month": "mon", "DayofMonth": "dom", "DayOfWeek": "dow", "Weekend": "CAST(dow > 5 AS INTEGER)",
    "DIYSin": "sin(2 * pi() * doy / 365)", "DIYCos": "cos(2 * pi() * doy / 365)", "HourSin": "sin(2 * pi() * hour / 24)",
    "HourCos": "cos(2 * pi() * hour / 24)", "HourS": "hour * hour", "DistanceS": "dist * dist", "HourDist": "hour * hour * dist * dist",
    "OriginDelayRate": "avg(known) OVER (PARTITION BY Origin)", "DestDelayRate": "avg(known) OVER (PARTITION BY Dest)",
    "CarrierDelayRate": "avg(known) OVER (PARTITION BY UniqueCarrier)", "IsHoliday": "CAST(holiday <> 'Non-Holiday' AS INTEGER)"}
_FLIGHT_TEXTS = ["SeasonType", "Year", "HolidayType", "DepTimeBin", "Route", "CarrierOrigin", "CarrierDest", "DistBin"]
_DAYS_BEFORE = "[0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334]"


@register("plan_delayed_flight", sql=f"""
WITH s AS (SELECT {_FLIGHT}, month(o_orderdate) AS mon, day(o_orderdate) AS dom, 1 + o_orderkey % 7 AS dow FROM orders),
a AS (SELECT *, CASE dep_delayed_15min WHEN 'Y' THEN 1 WHEN 'N' THEN 0 ELSE -1 END AS y, CASE dep_delayed_15min WHEN 'Y' THEN 1.0 WHEN 'N' THEN 0.0 END AS known,
  CAST(Distance AS BIGINT) AS dist, {_DAYS_BEFORE}[mon] + dom AS doy, CAST(DepTime // 100 % 24 AS DOUBLE) + DepTime % 100 / CAST(60 AS DOUBLE) AS hour FROM s),
b AS (SELECT *, 2018 - ((doy - dow) % 7 + 7) % 7 AS yr FROM a),
c AS (SELECT *, make_date(yr, mon, 1) + CAST(dom - 1 AS INTEGER) AS o_orderdate0 FROM b),
h AS (SELECT *, {_HOLIDAY_SQL.replace("dayofweek(o_orderdate)", "dayofweek(o_orderdate0)").replace("month(o_orderdate)", "mon").replace("day(o_orderdate)", "dom")} AS holiday FROM c)
SELECT id, {_round_sql(_FLIGHT_OUT)},
  CASE WHEN mon IN (12, 1, 2) THEN 'Winter' WHEN mon <= 5 THEN 'Spring' WHEN mon <= 8 THEN 'Summer' ELSE 'Fall' END AS SeasonType,
  'Y' || yr AS Year, holiday AS HolidayType,
  CASE WHEN DepTime <= 600 THEN 'vem' WHEN DepTime <= 900 THEN 'm' WHEN DepTime <= 1200 THEN 'mm' WHEN DepTime <= 1500 THEN 'maf'
       WHEN DepTime <= 1800 THEN 'af' WHEN DepTime <= 2100 THEN 'n' WHEN DepTime <= 2400 THEN 'nn' ELSE 'lm' END AS DepTimeBin,
  Origin || Dest AS Route, UniqueCarrier || Origin AS CarrierOrigin, UniqueCarrier || Dest AS CarrierDest,
  CASE WHEN dist <= 500 THEN 'very short' WHEN dist <= 1000 THEN 'short' WHEN dist <= 1500 THEN 'mid' WHEN dist <= 2000 THEN 'midlong'
       WHEN dist <= 2500 THEN 'long' ELSE 'very long' END AS DistBin
FROM h""")
def plan_delayed_flight(spark, d):
    flights = tbl(spark, d, "orders").selectExpr(*_columns(_FLIGHT))
    return _rounded(delayed_flight.preprocess(flights, select=False), "id", list(_FLIGHT_OUT), _FLIGHT_TEXTS)


# ---- C7 --------------------------------------------------------------------------------

_COUNTS = {"numeric_token_counts": math_prob.SYMBOLS, "num_count": r"\p{Nd}+", **math_prob.TOPICS}


@register("plan_math_prob", sql=f"""
WITH q AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN -1 ELSE doc_id % 8 END AS label, {_clean_sql("coalesce(text, '')")} AS q FROM documents)
SELECT doc_id, CAST(label AS DOUBLE) AS label, CAST(length(q) AS DOUBLE) AS length, round(ln(1 + length(q)), 6) AS log_length,
  CAST(len({_tokens_sql("q")}) AS DOUBLE) AS word_count,
  {", ".join(f"CAST(len(regexp_extract_all(q, '{p}')) AS DOUBLE) AS {n}" for n, p in _COUNTS.items())},
  {", ".join("CAST(" + " OR ".join(f"contains(q, '{w}')" for w in ws) + f" AS DOUBLE) AS {n}" for n, ws in math_prob.FLAGS.items())},
  md5(q) AS question FROM q""")
def plan_math_prob(spark, d):
    docs = wide(spark, tbl(spark, d, "documents")).selectExpr(
        "doc_id", "CASE WHEN doc_id % 4 = 0 THEN doc_id END AS id", "text AS Question",
        "CAST(CASE WHEN doc_id % 4 <> 0 THEN doc_id % 8 END AS INTEGER) AS label")
    out = math_prob.preprocess(docs).withColumn("question", F.md5(F.col("Question").cast("binary")))
    return _rounded(out, "doc_id", ["label", "length", "log_length", "word_count", *_COUNTS, *math_prob.FLAGS], ["question"])


# ---- C1 --------------------------------------------------------------------------------

_PASSENGER = """o_orderkey AS PassengerId, 1 + o_orderkey % 3 AS Pclass,
  concat('Smith, ', element_at(array('Mr. Jo', 'Mrs. Jo', 'Miss. Jo', 'Master. Jo', 'Dr. Jo', 'Lady. Jo', 'no title'), CAST(o_orderkey % 7 + 1 AS INT))) AS Name,
  CASE WHEN o_custkey % 2 = 0 THEN 'Male' ELSE 'female' END AS Sex,
  CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey % 70 AS DOUBLE) END AS Age, o_orderkey % 3 AS SibSp, o_custkey % 2 AS Parch,
  CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderkey AS STRING) ELSE concat('PC ', o_orderkey) END AS Ticket,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 10 = 0 THEN 0.0D ELSE round(o_totalprice / 1000, 2) END AS Fare,
  element_at(array(CAST(NULL AS STRING), 'C85', 'B20 B22', 'F E39', 'T'), CAST(o_custkey % 5 + 1 AS INT)) AS Cabin,
  CASE WHEN o_orderkey % 13 <> 0 THEN substring('SSC', CAST(o_custkey % 3 + 1 AS INT), 1) END AS Embarked"""
_PASSENGER_SQL = """o_orderkey AS PassengerId, 1 + o_orderkey % 3 AS Pclass,
  ['Mr', 'Mrs', 'Miss', 'Master', 'Mr', 'Mrs', NULL][CAST(o_orderkey % 7 + 1 AS INT)] AS title0,
  CASE WHEN o_custkey % 2 = 0 THEN 1 ELSE 0 END AS Sex,
  CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey % 70 AS DOUBLE) END AS Age0, o_orderkey % 3 AS SibSp, o_custkey % 2 AS Parch,
  CASE WHEN o_orderkey % 4 = 0 THEN 'No' ELSE 'PC' END AS TicketLetter, CAST(o_orderkey AS VARCHAR) AS TicketNumber,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 10 = 0 THEN 1.0 ELSE CAST(round(o_totalprice / 1000, 2) AS DOUBLE) END AS Fare0,
  ['N', 'C', 'B', 'F', 'T'][CAST(o_custkey % 5 + 1 AS INT)] AS CabinLet, [-1, 85, 21, 0, 0][CAST(o_custkey % 5 + 1 AS INT)] AS CabinNum,
  CASE WHEN o_orderkey % 13 <> 0 THEN substring('SSC', CAST(o_custkey % 3 + 1 AS INT), 1) END AS Embarked0"""
_PASSENGER_OUT = ["Pclass", "Age", "Sex", "SibSp", "Parch", "IsAdult", "FamSize", "hasNanny", "Fare", "CabinNum"]


@register("plan_titanic", sql=f"""
WITH s AS (SELECT {_PASSENGER_SQL} FROM orders),
a AS (SELECT *, CASE WHEN Age0 IS NOT NULL THEN CAST(Age0 >= 21 AS INTEGER) ELSE CAST(NOT coalesce(title0 IN ('Master', 'Miss'), false) AS INTEGER) END AS IsAdult FROM s),
t AS (SELECT *, CASE WHEN title0 = 'Miss' AND IsAdult = 1 THEN 'Mrs' WHEN title0 = 'Master' AND IsAdult = 1 THEN 'Mr'
                     WHEN title0 = 'Mr' AND IsAdult = 0 THEN 'Master' WHEN title0 = 'Mrs' AND IsAdult = 0 THEN 'Miss' ELSE title0 END AS Title FROM a),
m AS (SELECT Title AS mt, avg(Age0) AS ma FROM t WHERE Title IS NOT NULL GROUP BY 1),
f AS (SELECT Pclass AS fp, avg(Fare0) AS fa FROM t GROUP BY 1),
e AS (SELECT Embarked0 AS em FROM t WHERE Embarked0 IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
r AS (SELECT *, SibSp + Parch + 1 AS FamSize,
        coalesce(Age0, floor(ma) + CASE WHEN Title IN ('Mr', 'Master') THEN 0.5 ELSE 0 END, 28.0) AS Age, coalesce(Fare0, fa) AS Fare,
        coalesce(Embarked0, em) AS Embarked
      FROM t LEFT JOIN m ON Title = mt LEFT JOIN f ON Pclass = fp CROSS JOIN e)
SELECT PassengerId AS passengerid, {_round_sql({c: c for c in _PASSENGER_OUT if c != "hasNanny"})},
  round(CAST(CASE WHEN Title IS NULL THEN CASE WHEN FamSize = 1 THEN NULL ELSE 0 END
                  ELSE CAST(Title IN ('Master', 'Miss') AND FamSize = 1 AS INTEGER) END AS DOUBLE), 6) AS hasNanny,
  Title, TicketLetter, TicketNumber, CabinLet, Embarked
FROM r""")
def plan_titanic(spark, d):
    people = tbl(spark, d, "orders").selectExpr(*_columns(_PASSENGER))
    return _rounded(titanic.preprocess(people), "PassengerId", _PASSENGER_OUT, ["Title", "TicketLetter", "TicketNumber", "CabinLet", "Embarked"])


# ---- C4 --------------------------------------------------------------------------------

_FAMILIES = {"T": lambda i: f"CAST(((o_orderkey * {i} + o_custkey) % 97) AS DOUBLE) / 7",
             "S": lambda i: f"CASE WHEN (o_orderkey + {i}) % 11 <> 0 THEN CAST(((o_orderkey + o_custkey * {i}) % 89) AS DOUBLE) / 9 END",
             "O": lambda i: f"CAST(((o_orderkey + {i}) % 31) AS DOUBLE)"}
_SCALARS = ["Mass", "Rg", "NumHeteroatoms", "TPSA", "HDonors", "HAcceptors", "LogP", "LUMO(eV)", "HOMO(eV)", "LUMOp1(eV)", "HOMOm1(eV)",
            "TDOS3.2", "SDOS3.9", "TDOS3.7", "SDOS3.8", "TDOS4.3", "TDOS2.7", "TDOS3.6", "RDKit_8"]


def _molecules(quote: str) -> list[str]:
    cells = [f"{make(i)} AS {k}{i}" for k, make in _FAMILIES.items() for i in range(1, 21)]
    return cells + [f"1 + CAST(((o_orderkey * {j + 3} + o_custkey * {j + 1}) % {53 + 2 * j}) AS DOUBLE) / {j + 5} AS {quote}{n}{quote}"
                    for j, n in enumerate(_SCALARS)]


def _list(k: str) -> str:
    return "[" + ", ".join(f"{k}{i}" for i in range(1, 21)) + "]"


_MOLECULE_OUT = {
    **{f"{k}_{n}": f"list_{f}({_list(k)})" for k in "TS" for n, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))},
    "O_sum": f"list_sum({_list('O')})", "O_mean": f"list_avg({_list('O')})", "O_std": f"list_stddev_samp({_list('O')})",
    "T_range": f"list_max({_list('T')}) - list_min({_list('T')})", "S_range": f"list_max({_list('S')}) - list_min({_list('S')})",
    "min_diff_S_T": f"list_min({_list('S')}) - list_min({_list('T')})", "size_index": "Mass / (Rg + 1e-6)",
    "hetero_polarity": "NumHeteroatoms * TPSA", "Ncomplexity": "NumHeteroatoms + Rg * 0.5 + TPSA * 0.1",
    "ratio_HDonors_HAcceptors": "HDonors / (HAcceptors + 1e-6)", "mass_minus_logP": "Mass - LogP", "total_H_bonds": "HDonors + HAcceptors",
    "energy_gap": "gap", "delta_LUMO": "dl", "delta_HOMO": "dh", "chemical_potential": "mu", "hardness": "gap / 2",
    "combined_orbital_feature": "dl - dh", "ratio_LUMO": "dl / (gap + 1e-6)", "ratio_HOMO": "dh / (gap + 1e-6)"}


@register("plan_molecular", sql=f"""
WITH s AS (SELECT o_orderkey AS Batch_ID, {", ".join(_molecules('"'))} FROM orders),
g AS (SELECT *, "LUMO(eV)" - "HOMO(eV)" AS gap, "LUMOp1(eV)" - "LUMO(eV)" AS dl, "HOMO(eV)" - "HOMOm1(eV)" AS dh,
        ("HOMO(eV)" + "LUMO(eV)") / 2 AS mu FROM s)
SELECT Batch_ID AS batch_id, {_round_sql(_MOLECULE_OUT)} FROM g""")
def plan_molecular(spark, d):
    """The row statistics and ratios (ratios by a difference near zero are left to the fixtures)."""
    rows = tbl(spark, d, "orders").selectExpr("o_orderkey AS Batch_ID", *_molecules("`"))
    return _rounded(molecular.preprocess(rows, select=False), "Batch_ID", list(_MOLECULE_OUT))
