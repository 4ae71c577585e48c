"""The blend sweeps against every weight evaluated on every row."""

import math
import random

import pytest

from gristmill.operators.models import blend_sweep

RNG = random.Random(8)
GRID = [k / 64 for k in range(65)]  # many exact ties with the cutoff


def cases():
    rows = [(float(RNG.randint(0, 1)), RNG.choice(GRID), RNG.choice(GRID)) for _ in range(400)]
    rows += [(1.0, 0.5, 0.5), (0.0, 0.5, 0.5), (1.0, 1.0, 0.0), (0.0, 0.0, 1.0), (2.0, 0.9, 0.1), (1.0, 0.5, 0.3), (0.0, 0.3, 0.5)]
    return rows + [(None, 0.1, 0.2), (1.0, None, 0.2), (0.0, 0.3, None)]


def direct(rows, metric, step):
    n = round(1 / step) + 1
    out = []
    for i in range(n):
        w = i * step
        ps = [(y, w * a + (1.0 - w) * b) for y, a, b in rows if None not in (y, a, b)]
        out.append({"accuracy": lambda: sum((p > 0.5) == y if y in (0, 1) else False for y, p in ps) / len(ps),
                    "mae": lambda: sum(abs(p - y) for y, p in ps) / len(ps),
                    "rmse": lambda: math.sqrt(sum((p - y) ** 2 for y, p in ps) / len(ps)),
                    "rmsle": lambda: math.sqrt(sum((math.log1p(p) - math.log1p(y)) ** 2 for y, p in ps) / len(ps))}[metric]())
    return out


@pytest.mark.parametrize("metric", ["accuracy", "mae", "rmse", "rmsle"])
@pytest.mark.parametrize("step", [0.01, 0.25])
def test_sweep_equals_direct_evaluation(spark, metric, step):
    rows = cases()
    got = blend_sweep(spark.createDataFrame(rows, "y double, a double, b double"), "y", "a", "b", metric, step).orderBy("i").collect()
    want = direct(rows, metric, step)
    if metric == "accuracy":
        assert [r["metric"] for r in got] == want
    else:
        assert all(math.isclose(r["metric"], x, rel_tol=1e-9, abs_tol=1e-12) for r, x in zip(got, want))
    best = (max if metric == "accuracy" else min)(r["metric"] for r in got)
    assert [r["i"] for r in got if r["best"]] == [next(r["i"] for r in got if r["metric"] == best)]
    assert len(got) == len(want)


def test_no_rows(spark):
    got = blend_sweep(spark.createDataFrame([], "y double, a double, b double"), "y", "a", "b").collect()
    assert len(got) == 101 and all(r["metric"] is None and r["best"] == 0 for r in got)
