"""The value-count table against pandas, and its users against the one-statistic operators."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gristmill.core import materialize
from gristmill.operators.impute import GlobalImputer, GroupImputer, fill_groups
from gristmill.operators.valuecounts import ValueCounts

RNG = random.Random(6)


@pytest.fixture(scope="module")
def data(spark):
    rows = [(i, RNG.choice(["a", "a", "a", "b", None]), RNG.choice([None, float(RNG.randint(0, 9)), RNG.gauss(0, 5)]),
             RNG.choice([None, float(RNG.randint(0, 3)), float("nan")]), RNG.choice(["x", "y", "z", None])) for i in range(500)]
    rows += [(600 + i, "c", None, 1.0, None) for i in range(5)]
    df = spark.createDataFrame(rows, "id int, g string, p double, q double, t string")
    return df, pd.DataFrame(rows, columns=["id", "g", "p", "q", "t"])


def key(x):
    return None if x is None or (isinstance(x, float) and np.isnan(x)) else x


def test_statistics_equal_pandas(spark, data):
    df, pdf = data
    vc = ValueCounts.fit(df, numbers=["p", "q"], texts=["t"], by=["g"])
    groups = pdf.assign(g=pdf["g"].fillna("-")).groupby("g")
    q = {(r["column"], r["g"] or "-"): (r["q0"], r["q1"], r["n"]) for r in vc.quantiles([0.5, 0.9]).collect()}
    means = {(r["column"], r["g"] or "-"): r["mean"] for r in vc.means().collect()}
    counts = {(r["column"], r["g"] or "-"): (r["n_values"], r["n_missing"], r["n_distinct"]) for r in vc.counts().collect()}
    for g, part in groups:
        for c in "pq":
            x = part[c].dropna()
            assert counts[c, g] == (len(x), len(part) - len(x), x.nunique())
            if len(x):
                assert np.allclose(q[c, g], (x.median(), x.quantile(0.9), len(x))) and np.isclose(means[c, g], x.mean())
            else:
                assert (c, g) not in q and (c, g) not in means
        assert counts["t", g][2] == part["t"].nunique()
    modes = {(r["column"], r["g"] or "-"): r["mode"] for r in vc.modes().collect()}
    for g, part in groups:
        x = part["t"].dropna()
        assert modes.get(("t", g)) == (sorted(x.mode())[0] if len(x) else None)
    whole = vc.quantiles([0.25], by=()).where("column = 'p'").first()
    assert np.isclose(whole["q0"], pdf["p"].quantile(0.25)) and whole["n"] == pdf["p"].count()


def test_quantiles_beyond_the_driver_bound(spark, data, monkeypatch):
    from gristmill.operators import valuecounts
    vc = ValueCounts.fit(data[0], numbers=["p", "q"], by=["g"])
    near = sorted(map(str, vc.quantiles([0.0, 0.3, 1.0]).collect()))
    monkeypatch.setattr(valuecounts, "DRIVER_CELLS", 2)
    assert sorted(map(str, vc.quantiles([0.0, 0.3, 1.0]).collect())) == near and len(near) == 7


def test_filled_counts_equal_the_filled_rows(spark, data):
    df, _ = data
    vc = ValueCounts.fit(df, numbers=["p"], by=["g"])
    medians = materialize(vc.quantiles([0.5], ["m"]).drop("n", "column"))
    got = vc.filled(medians, "m").quantiles([0.1, 0.5, 0.75], by=()).first()
    rows = GroupImputer("p", ["g"], "median").fit(df).transform(df)
    want = [r["p"] for r in rows.where("p is not null").collect()]
    assert got["n"] == len(want) and np.allclose([got["q0"], got["q1"], got["q2"]], np.quantile(want, [0.1, 0.5, 0.75]))


@pytest.mark.parametrize("stat", ["median", "mean", "mode"])
def test_fill_groups_equals_one_by_one(spark, data, stat):
    df, _ = data
    df = df.withColumn("q", F.when(~F.isnan("q"), F.col("q")))
    one = df
    for c in ("p", "q"):
        one = GroupImputer(c, ["g"], stat).fit(one).transform(one)
    many = fill_groups(df, ["p", "q"], ["g"], stat)
    row = lambda r: (r["id"], *[None if r[c] is None else round(r[c], 9) for c in ("p", "q")])
    assert sorted(map(row, many.collect())) == sorted(map(row, one.collect()))
    assert many.columns == one.columns or set(many.columns) == set(one.columns)


def test_global_modes_of_texts_in_one_table(spark, data):
    df, pdf = data
    out = GlobalImputer(["t", "g"], "mode").fit(df)
    assert out.values == {c: sorted(pdf[c].dropna().mode())[0] for c in ("t", "g")}


def test_no_rows(spark, data):
    df, _ = data
    vc = ValueCounts.fit(df.where("false"), numbers=["p"], texts=["t"], by=["g"])
    assert vc.quantiles([0.5]).collect() == vc.modes().collect() == vc.means().collect() == vc.counts().collect() == []
