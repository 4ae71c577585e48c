"""Domain plans C1-C10 on small hand-made fixtures (schemas of FIXTURES.md):
shape, no gaps after imputation, and the documented quirks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gristmill.plans import (calories, delayed_flight, housing, loan, math_exam, math_prob, molecular,
                             russian_car, spaceship, titanic)


def nulls(df, cols):
    return {c: df.where(F.col(f"`{c}`").isNull()).count() for c in cols}


# ---- C1 ---------------------------------------------------------------------------------

TITANIC_ROWS = [
    (1, 0, 3, 'Braund, Mr. Owen Harris', 'male', 22.0, 1, 0, 'A/5 21171', 7.25, None, 'S'),
    (2, 1, 1, 'Cumings, Mrs. John Bradley (Florence Briggs Thayer)', 'female', 38.0, 1, 0, 'PC 17599', 71.28, 'C85', 'C'),
    (3, 1, 3, 'Heikkinen, Miss. Laina', 'female', 26.0, 0, 0, 'STON/O2. 3101282', 7.93, None, 'S'),
    (4, 1, 1, 'Futrelle, Mrs. Jacques Heath', 'female', 15.0, 1, 0, '113803', 53.1, 'C23 C25 C27', 'S'),
    (5, 0, 3, 'Allen, Mr. William Henry', 'male', 12.0, 0, 0, '373450', 8.05, None, None),
    (6, 0, 3, 'Moran, Master. James', 'male', 25.0, 0, 0, '330877', 0.0, 'T', 'Q'),
    (7, 0, 1, 'McCarthy, Don. Timothy', 'male', None, 0, 0, 'LINE', None, 'F G73', 'S'),
    (8, 1, 2, 'Oliva, Dona. Fermina', 'female', None, 0, 0, ' ', 13.0, None, 'C'),
    (9, 1, 2, 'Rothes, the Countess. of', 'female', 33.0, 0, 0, '110152', 86.5, 'B77', 'Q'),
    (10, None, 3, 'Kelly, Mlle. Anna', 'female', None, 0, 2, '330911', 7.83, None, 'Q'),
    (11, None, 3, 'Nobody, Unknown. Person', 'male', None, 0, 0, '2343', 9.0, None, 'S'),
    (12, None, 3, 'Small, Miss. Ada', 'female', 8.0, 0, 0, '1234', 5.0, None, 'S'),
]
TITANIC_SCHEMA = ("PassengerId long, Survived int, Pclass int, Name string, Sex string, Age double, SibSp int, "
                  "Parch int, Ticket string, Fare double, Cabin string, Embarked string")


def test_titanic(spark):
    df = spark.createDataFrame(TITANIC_ROWS, TITANIC_SCHEMA)
    out = titanic.preprocess(df)
    assert {"Name", "Ticket", "Cabin"}.isdisjoint(out.columns)
    assert nulls(out, ["Age", "Fare", "Embarked", "CabinLet", "CabinNum", "Sex"]) == \
        {"Age": 0, "Fare": 0, "Embarked": 0, "CabinLet": 0, "CabinNum": 0, "Sex": 0}
    r = {x.PassengerId: x for x in out.collect()}
    assert r[4].Title == "Miss"  # Mrs aged 15 -> Miss
    assert r[5].Title == "Master" and r[6].Title == "Mr"  # Mr aged 12, Master aged 25
    assert r[7].Title == "Mr" and r[8].Title == "Mr"  # K9: "Don" also matches "Dona"
    assert r[11].Age == 28.0  # no title: default age
    mr_mean = (22.0 + 25.0) / 2  # Mr ages known: 22 and the adult master
    assert r[7].Age == int(mr_mean) + 0.5  # K10: floor + 0.5 for male titles
    assert (r[2].CabinLet, r[2].CabinNum) == ("C", 85) and (r[4].CabinLet, r[4].CabinNum) == ("C", 25)
    assert (r[6].CabinLet, r[6].CabinNum) == ("T", 0) and (r[7].CabinLet, r[7].CabinNum) == ("F", 0)
    assert (r[1].CabinLet, r[1].CabinNum) == ("N", -1)
    assert (r[1].TicketLetter, r[1].TicketNumber) == ("A/5", "21171")
    assert (r[8].TicketLetter, r[8].TicketNumber) == ("No", "0")
    assert r[6].Fare == 1.0 and r[5].Embarked == "S"
    assert r[3].Title == "Mrs" and r[3].hasNanny == 0  # Miss aged 26 -> Mrs
    assert r[12].Title == "Miss" and r[12].hasNanny == 1


# ---- C3 ---------------------------------------------------------------------------------

def spaceship_rows():
    rnd = random.Random(0)
    rows = []
    planets = ["Earth", "Europa", "Mars", None]
    for i in range(40):
        g = i // 3
        spend = [None if rnd.random() < 0.1 else float(rnd.choice([0, 0, 10, 200])) for _ in range(5)]
        rows.append((f"{g:04d}_{i % 3 + 1:02d}", rnd.choice(planets), rnd.choice([True, False, None]),
                     rnd.choice([f"B/{i}/P", f"F/{i}/S", None]), rnd.choice(["TRAPPIST-1e", "55 Cancri e", None]),
                     None if rnd.random() < 0.2 else float(rnd.randint(1, 70)), rnd.choice([True, False, None]),
                     *spend, rnd.choice(["Ann Lee", "Bo Kim", None]), rnd.choice([True, False, None])))
    rows.append(("0999_01", None, None, None, None, None, None, None, None, None, None, None, None, None))
    return rows


SPACESHIP_SCHEMA = ("PassengerId string, HomePlanet string, CryoSleep boolean, Cabin string, Destination string, "
                    "Age double, VIP boolean, RoomService double, FoodCourt double, ShoppingMall double, "
                    "Spa double, VRDeck double, Name string, Transported boolean")


def test_spaceship(spark):
    df = spark.createDataFrame(spaceship_rows(), SPACESHIP_SCHEMA)
    out = spaceship.preprocess(df, k=3, restarts=1)
    cols = ["HomePlanet", "Destination", "Age", "CryoSleep", "VIP", "TotalBill", "DeckCab", "Cluster"] + \
        spaceship.SERVICES
    assert all(v == 0 for v in nulls(out, cols).values())
    assert {"Centroid0", "Centroid2", "Hp_1", "Group", "NumInGroup"} <= set(out.columns)
    row = out.where(F.col("PassengerId") == "0999_01").first()
    assert row.CryoSleep == 1 and row.RoomService == 0.0  # inactive -> asleep -> services 0
    assert row.Transported == -1


# ---- C4 ---------------------------------------------------------------------------------

def molecular_frame(spark):
    base = ["Mass", "HAcceptors", "HDonors", "LogP", "Rg", "TPSA", "NumHeteroatoms", "RDKit_8",
            "HOMOm1(eV)", "HOMO(eV)", "LUMO(eV)", "LUMOp1(eV)"]
    fam = [f"{k}{i}" for k in "TSO" for i in range(1, 21)]
    tdos = ["TDOS2.7", "TDOS3.2", "TDOS3.6", "TDOS3.7", "TDOS4.3", "SDOS3.8", "SDOS3.9"]
    names = base + fam + tdos
    rnd = random.Random(5)
    rows = []
    for i in range(30):
        vals = [rnd.uniform(0.5, 5) for _ in names]
        rec = dict(zip(names, vals))
        if i == 0:
            rec["LUMO(eV)"] = rec["HOMO(eV)"]  # zero energy gap
            rec["Rg"] = 0.0
        if i == 1:
            for j in range(1, 21):
                rec[f"O{j}"] = None
        if i == 2:
            rec["T5"] = None
        rows.append((f"{'Train' if i < 24 else 'Test'}-{i}", "CCO", None if i >= 24 else rnd.uniform(10, 100),
                     *[rec[n] for n in names]))
    schema = "Batch_ID string, Smiles string, T80 double, " + ", ".join(f"`{n}` double" for n in names)
    return spark.createDataFrame(rows, schema)


def test_molecular(spark):
    df = molecular_frame(spark)
    full = molecular.preprocess(df, select=False)
    r = {x.Batch_ID: x for x in full.collect()}
    assert r["Train-0"].electrophilicity is None and r["Train-0"].energy_gap == 0.0
    assert r["Train-1"].O_sum == 0.0 and r["Train-1"].O_mean is None
    assert r["Train-2"].T_mean is not None
    sel = molecular.preprocess(df, select=True)
    assert {"Batch_ID", "T80", "Smiles"} <= set(sel.columns) and sel.count() == 30


# ---- C5 ---------------------------------------------------------------------------------

def test_russian_car(spark):
    plates = ["A001BC77", "M010AA97", "X101XX01", "E123KX77", "A777AA54", "A500AA54", "B900OO81",
              "K123KK177", "A456BA04", "C321CA85", "A555AA84", "A777AA77"]
    base = dt.datetime(2024, 1, 5)
    rows = []
    for i, p in enumerate(plates * 2):
        rows.append((i, p, base + dt.timedelta(days=(i * 37) % 400), None if i % 4 == 3 else 1000.0 * (i + 1)))
    df = spark.createDataFrame(rows, "id long, plate string, date timestamp, price double")
    region = spark.createDataFrame([("01", "Adygea", 0), ("04", "Altai", 1), ("77", "Moscow", 2), ("81", "A81", 3),
                                    ("81", "B81", 4), ("177", "Moscow", 5), ("54", "Novosibirsk", 6)],
                                   "code string, region_name string, pos int")
    gov = spark.createDataFrame([("EKX", "77", "x", 0, 1, 6, 0), ("AAA", "54", "y", 0, 1, 3, 1),
                                 ("AAA", "54", "z", 0, 0, 9, 2), ("ААА", "77", "cyr", 0, 1, 7, 3)],
                                "letters string, region string, description string, forbidden int, "
                                "advantage int, significance int, pos int")
    out = russian_car.preprocess(df, region, gov, select=False)
    r = {x.id: x for x in out.collect()}
    assert (r[0].first_letter, r[0].number, r[0].second_letter, r[0].region_code) == ("A", 1, "BC", 77)
    assert r[2].region_name == "Adygea"  # zero-padded region 01 matches (K11 fixed)
    assert r[6].region_name == "A81"  # 81 listed twice: first wins
    assert (r[4].advantage_on_road, r[4].significance) == (1, 3)  # first AAA/54 entry wins
    assert (r[11].advantage_on_road, r[11].significance) == (1, 7)  # Cyrillic look-alikes normalised (K22)
    assert (r[1].advantage_on_road, r[1].significance) == (0, 0)
    assert r[0].has_sequential_numbers_number == 0 and r[3].has_sequential_numbers_number == 1
    assert r[0].prestigious == 1 and r[2].prestigious == 1
    assert r[0].listing_num == 1 and r[12].listing_num == 2  # same plate, later date
    assert r[3].price is None and r[0].avg_price_by_combine is not None
    compat = russian_car.preprocess(df, region, gov, select=False, reference_compat=True)
    assert compat.where(F.col("id") == 2).first().region_name == "None"


# ---- C6 ---------------------------------------------------------------------------------

def loan_rows():
    rnd = random.Random(7)
    homes = ["Own Home", "Rent", "Home Mortgage", "Have Mortgage"]
    jobs = ["< 1 year", "10+ years", "2 years", None, "5 years"]
    hist = [0.0, 5.0, 5.1, 50.0, 51.0, 12.0, 18.0]
    rows = []
    for i in range(60):
        rows.append((i, homes[i % 4], None if i % 7 == 0 else float(rnd.randint(20000, 200000)), jobs[i % 5],
                     float(i % 2), float(i % 3 == 0), hist[i % len(hist)], float(rnd.randint(1000, 90000)),
                     None if i % 5 == 0 else float(rnd.randint(0, 80)), None if i % 9 == 0 else float(i % 2),
                     rnd.choice(["debt", None]), rnd.choice(["Short Term", None]), float(rnd.randint(1000, 9000)),
                     float(rnd.randint(100, 9000)), float(rnd.randint(10, 900)),
                     None if i % 6 == 0 else float(rnd.randint(600, 750)), None if i >= 50 else i % 2))
    return rows


LOAN_SCHEMA = ("Id long, `Home Ownership` string, `Annual Income` double, `Years in current job` string, "
               "`Tax Liens` double, `Number of Credit Problems` double, `Years of Credit History` double, "
               "`Maximum Open Credit` double, `Months since last delinquent` double, Bankruptcies double, "
               "Purpose string, Term string, `Current Loan Amount` double, `Current Credit Balance` double, "
               "`Monthly Debt` double, `Credit Score` double, `Credit Default` int")


def test_loan(spark):
    df = spark.createDataFrame(loan_rows(), LOAN_SCHEMA)
    out = loan.preprocess(df, k=3, restarts=1, select=False)
    assert all(v == 0 for v in nulls(out, ["Annual Income", "Credit Score", "Years in current job",
                                           "Income Group", "Credit Score Group"]).values())
    r = {x.Id: x for x in out.collect()}
    assert r[0]["Home Ownership"] == "Home" and r[1]["Home Ownership"] == "Rent"
    assert r[2]["Home Ownership"] == "Mortgage" and r[3]["Home Ownership"] == "Mortgage"
    assert r[0]["Years in current job"] == 0.5 and r[1]["Years in current job"] == 10.5
    assert r[0]["Credit History Group"] is None  # 0 is outside (0, 5]
    assert r[1]["Credit History Group"] == "Very Short" and r[2]["Credit History Group"] == "Short"
    assert r[4]["Credit History Group"] is None  # 51 > 50
    sel = loan.preprocess(df, k=3, restarts=1, select=True)
    assert {"Id", "Credit Default"} <= set(sel.columns)


# ---- C7 ---------------------------------------------------------------------------------

def test_math_prob(spark):
    rows = [(None, "Solve $x^2 = 4$ for x", 0), (None, r"Prove that \frac{a}{b} is a ring", 5),
            (None, "Find the area of a circle", 1), (None, "Compute the derivative of f(x)", 2),
            (None, "probability of a random variable", 3), (None, None, 4), (None, "matrix 2x x2", 0),
            (None, "Determine the angle", 1), (1, "find the integral", None), (2, "prove it", None)]
    df = spark.createDataFrame(rows, "id long, Question string, label int")
    out = math_prob.preprocess(df)
    r = out.collect()
    assert r[0].Question == "solve dollar expr x to the power of 2 equals 4 dollar expr for x"
    assert r[1].is_proof == 1 and r[1].topo_count == 1
    assert r[5].Question == "" and r[5].length == 0 and r[5].word_count == 0
    assert r[6].Question == "matrix 2 x x 2" and r[6].is_matrix == 1
    dist = math_prob.label_distribution(out).collect()
    assert [x.label for x in dist] == [0, 1, 2, 3, 4, 5] and sum(x["count"] for x in dist) == 8
    assert dist[0].percent == 25.0
    pred = math_prob.fit_predict(out, {0: 0, 1: 1, 2: 0, 3: 2, 4: 2, 5: 1}, max_features=50, num_trees=3)
    assert pred.count() == 2


# ---- C8 ---------------------------------------------------------------------------------

def test_math_exam(spark):
    rnd = random.Random(11)
    ages = [20.0, 20.5, 30.0, 60.0, 61.0]
    rows = [(i, ages[i % 5], float(i % 3), float(rnd.randint(1000, 4000)), float(i % 4),
             *[float((i >> b) & 1) for b in range(6)], None if i >= 30 else float(rnd.randint(30, 90)))
            for i in range(40)]
    schema = ("Id long, age double, years_of_experience double, lesson_price double, qualification double, "
              "physics double, chemistry double, biology double, english double, geography double, history double, "
              "mean_exam_points double")
    df = spark.createDataFrame(rows, schema)
    out = math_exam.preprocess(df, k=3, restarts=1, select=False)
    r = {x.Id: x for x in out.collect()}
    assert [r[i].age_bin for i in range(5)] == [1, 2, 2, 5, 6]
    assert r[0].years_of_experience == 0.5 and r[1].years_of_experience == 1.0
    assert r[0].total_subject_binary == 0 and r[63 % 40].total_subject_binary is not None
    assert r[1].total_subject_binary == 32  # physics bit (i=1 -> physics flag only)
    sel = math_exam.preprocess(df, k=3, restarts=1, select=True)
    assert "age_bin" not in sel.columns and {"Id", "mean_exam_points"} <= set(sel.columns)


# ---- C9 ---------------------------------------------------------------------------------

def test_delayed_flight(spark):
    cases = [("c-1", "c-1", "c-1", 0), ("c-7", "c-4", "c-3", 459), ("c-11", "c-11", "c-6", 460),
             ("c-12", "c-25", "c-2", 600), ("c-2", "c-29", "c-4", 601), ("c-2", "c-30", "c-5", 1159),
             ("c-1", "c-15", "c-1", 1160), ("c-11", "c-22", "c-4", 2059), ("c-5", "c-28", "c-1", 2400),
             ("c-9", "c-3", "c-1", 2401), ("c-10", "c-8", "c-1", 2534), ("c-6", "c-30", "c-7", 1200)]
    rows = [(i, m, dom, dow, t, ["AA", "UA"][i % 2], ["ATL", "JFK", "SFO"][i % 3], ["LAX", "ORD"][i % 2],
             [500, 501, 2500, 2501][i % 4], [None, "N", "Y"][i % 3]) for i, (m, dom, dow, t) in enumerate(cases)]
    schema = ("id long, Month string, DayofMonth string, DayOfWeek string, DepTime int, UniqueCarrier string, "
              "Origin string, Dest string, Distance int, dep_delayed_15min string")
    df = spark.createDataFrame(rows, schema)
    out = delayed_flight.preprocess(df, select=False)
    r = {x.id: x for x in out.collect()}
    assert r[0].HolidayType == "New Year's Day" and r[1].HolidayType == "Independence Day"
    assert r[3].HolidayType == "Christmas Day" and r[5].HolidayType == "Non-Holiday"  # 30 Feb
    assert r[0].Year == "Y2018" and r[0].SeasonType == "Winter" and r[11].Weekend == 1
    assert [r[i].DepTimeBin for i in (0, 3, 4, 8, 9)] == ["vem", "vem", "m", "nn", "lm"]
    assert [r[i].DistBin for i in range(4)] == ["very short", "short", "long", "very long"]
    assert r[0].dep_delayed_15min == -1 and r[1].dep_delayed_15min == 0 and r[2].dep_delayed_15min == 1
    assert r[0].CarrierOrigin == "AAATL" and r[0].Route == "ATLLAX"
    assert r[0].OriginDelayRate is None  # every ATL row has an unknown label
    assert r[1].OriginDelayRate == 0.0 and r[2].OriginDelayRate == 1.0
    sel = delayed_flight.preprocess(df, select=True)
    assert {"id", "dep_delayed_15min"} <= set(sel.columns)


# ---- C10 --------------------------------------------------------------------------------

def test_calories(spark):
    rnd = random.Random(13)
    first = [(i, rnd.choice(["male", "female"]), float(rnd.randint(20, 70)), float(rnd.randint(150, 200)),
              float(rnd.randint(45, 110)), float(rnd.randint(1, 30)), float(rnd.randint(80, 130)),
              float(rnd.randint(39, 41)), None if i in (750000, 5000000, 749999) else float(rnd.randint(10, 300)))
             for i in [749999, 750000, 5000000, 5000001] + list(range(30))]
    schema = ("id long, Sex string, Age double, Height double, Weight double, Duration double, Heart_Rate double, "
              "Body_Temp double, Calories double")
    df1 = spark.createDataFrame(first, schema)
    second = spark.createDataFrame([(900000 + i, "female", 30.0, 170.0, 60.0, 10.0, 100.0, 40.0, 50.0)
                                    for i in range(3)], schema.replace("id long", "User_ID long")
                                   .replace("Sex string", "Gender string"))
    out = calories.preprocess(df1, second, select=False)
    assert out.count() == 37
    r = {x.id: x for x in out.collect()}
    assert r[900000].BMR == 10 * 60 + 6.25 * 170 - 5 * 30 - 161
    compat = calories.preprocess(df1, second, select=False, reference_compat=True)
    assert compat.where(F.col("id") == 900000).first().BMR == 10 * 60 + 6.25 * 170 - 5 * 30 + 5  # K2
    assert all(v == 0 for v in nulls(out, ["BMI", "BMR", "TDEE"]).values())
    sel = calories.preprocess(df1, second, select=True)
    assert {"id", "Calories"} <= set(sel.columns)


# ---- C2 ---------------------------------------------------------------------------------

def housing_frame(spark):
    rnd = random.Random(17)
    quals = ["Po", "Fa", "TA", "Gd", "Ex", None]
    rows = []
    for i in range(40):
        built = 1950 + (i * 7) % 60
        rows.append(dict(
            Id=i + 1, SalePrice=None if i >= 32 else float(rnd.randint(80000, 400000)),
            LotArea=float(rnd.randint(3000, 20000)), YearBuilt=built, YearRemodAdd=built + i % 10,
            YrSold=[built + 10, built + 30, built + 50, built - 1][i % 4],
            GarageYrBlt=[None, 2207.0, float(built)][i % 3],
            MasVnrArea=None if i % 5 == 0 else float(i * 10), BsmtFinSF1=float(i * 20), BsmtFinSF2=0.0,
            TotalBsmtSF=float(500 + i * 10), **{"1stFlrSF": float(800 + i * 5), "2ndFlrSF": float(i % 3 * 300),
                                                 "3SsnPorch": 0.0, "FireplaceQu": quals[i % 6]},
            GrLivArea=float(900 + i * 20), BedroomAbvGr=i % 4, TotRmsAbvGrd=4 + i % 5, FullBath=1 + i % 2,
            HalfBath=i % 2, BsmtFullBath=None if i == 3 else float(i % 2), BsmtHalfBath=0.0,
            GarageArea=float(200 + i), WoodDeckSF=float(i % 2 * 50), OpenPorchSF=float(i % 3 * 10),
            EnclosedPorch=0.0, ScreenPorch=0.0,
            OverallQual=[5, 6, 7, 10, None][i % 5], OverallCond=[5, 6, 7][i % 3],
            ExterQual=quals[i % 5], KitchenQual=quals[(i + 1) % 5], BsmtQual=quals[i % 6], BsmtCond=quals[(i + 2) % 6],
            GarageQual=quals[(i + 3) % 6], Utilities=["AllPub", "ELO"][i % 2], LotShape="Reg",
            Neighborhood=["NAmes", "CollgCr", "OldTown"][i % 3], BldgType=["1Fam", "TwnhsE"][i % 2],
            Exterior2nd=["Brk Cmn", "VinylSd"][i % 2], MSZoning=[None, "RL"][i % 2]))
    cols = list(rows[0])
    types = {c: ("long" if c in ("Id", "YearBuilt", "YearRemodAdd", "YrSold", "BedroomAbvGr", "TotRmsAbvGrd",
                                 "FullBath", "HalfBath", "OverallQual", "OverallCond") else
                 "string" if isinstance(rows[1][c], str) or c in ("FireplaceQu", "MSZoning") else "double")
             for c in cols}
    schema = ", ".join(f"`{c}` {types[c]}" for c in cols)
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], schema)


def test_housing(spark):
    df = housing_frame(spark)
    out = housing.preprocess(df, k=3, restarts=1, num_trees=5, select=False)
    assert {"FirstFlrSF", "Threeseasonporch", "FireplaceQual", "Bldg_1Fam", "Centroid2", "TotalBath"} <= set(out.columns)
    assert all(v == 0 for v in nulls(out, ["OverallQual", "GarageYrBlt", "MasVnrArea", "BsmtFullBath",
                                           "CompositeQual", "MSZoning"]).values())
    r = {x.Id: x for x in out.collect()}
    assert r[1].Exterior2nd == "BrkComm" and r[2].Exterior2nd == "VinylSd"
    assert r[1].GarageYrBlt == r[1].YearBuilt and r[2].GarageYrBlt == r[2].YearBuilt  # NULL and 2207 (K6)
    assert r[4].HouseAge == 0  # sold before built -> floored at 0
    assert r[1].HouseCond == 0 and r[2].HouseCond == 2 and r[3].HouseCond == 2  # 10/20, 30/20, 50/20 half-even
    assert r[2].Utilities == "None"  # unlisted level -> None
    assert r[4].OverallQual == 10  # level 10 kept (K4 fixed)
    assert r[33].SalePrice is None  # K5: target never imputed
