"""Batched boosting against a plain loop, single models and its own scores."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.operators import boosting as B

RNG = np.random.default_rng(4)


@pytest.fixture(scope="module")
def rows():
    out = []
    for i in range(600):
        x = [float(RNG.integers(0, 9)), float(RNG.normal()), float(RNG.integers(0, 2)), None if i % 17 == 0 else float(RNG.normal())]
        z = (x[0] > 4) + (x[1] > 0) * x[2] + (0.5 if x[3] is None else 0.0) + RNG.normal() * 0.3
        out.append((i, x, float(z > 1.0), float(z), i % 3))
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "id long, x array<double>, y double, z double, fold int").cache()


def brute(rows, borders, c, rounds, loss, held_out=None, label=2):
    """Symmetric trees without bootstrap by exhaustive search; margins of all rows after each round."""
    x = np.array([[-math.inf if v is None else v for v in r[1]] for r in rows])
    y = np.array([r[label] for r in rows])
    fit = np.array([r[4] != held_out for r in rows])
    start = y.mean() if loss == "squared" else math.log(y.mean() / (1 - y.mean()))
    m = np.full(len(rows), start)
    out = []
    for _ in range(rounds):
        p = m if loss == "squared" else 1 / (1 + np.exp(-m))
        g, h = p - y, np.ones(len(y)) if loss == "squared" else p * (1 - p)
        leaf = np.zeros(len(rows), int)
        for _ in range(c.depth):
            def gain(split):
                total = 0.0
                to = leaf * 2 + (x[:, split[0]] > split[1])
                for cells, sign in ((to, 1), (leaf, -1)):
                    for q in np.unique(cells[fit]):
                        at = fit & (cells == q)
                        total += sign * g[at].sum() ** 2 / (h[at].sum() + c.l2)
                return total
            options = [(f, b) for f, bs in enumerate(borders) for b in bs]
            gains = [gain(o) for o in options]
            if max(gains) <= 1e-9:
                break
            leaf = leaf * 2 + (x[:, options[int(np.argmax(gains))][0]] > options[int(np.argmax(gains))][1])
        step = np.zeros(len(rows))
        for q in np.unique(leaf):
            at = fit & (leaf == q)
            step[leaf == q] = -c.learning_rate * g[at].sum() / (h[at].sum() + c.l2) if at.any() else 0.0
        m = m + step
        out.append(m)
    return out


@pytest.mark.parametrize("block", [1 << 14, 97])
def test_models_equal_a_plain_loop(spark, df, rows, monkeypatch, block):
    monkeypatch.setattr(B, "BLOCK_ROWS", block)
    c = B.Candidate(depth=3, learning_rate=0.3, l2=2.0, bagging_temperature=0.0, min_gain=1e-6)
    got = B.boost(df, "x", "y", [B.Job(c, 1), B.Job(c)], "id", "fold", rounds=4, max_bins=8)
    for model, held in zip(got.models, (1, None)):
        want = brute(rows, model.borders, c, 4, "logistic", held)
        margins = [r["m"] for r in df.select("id", model.margin("x").alias("m")).orderBy("id").collect()]
        assert np.allclose(margins, want[-1], atol=1e-4)
    held = np.array([r[4] == 1 for r in rows])
    y = np.array([r[2] for r in rows])
    want = brute(rows, got.models[0].borders, c, 4, "logistic", 1)
    for (n, right, loss), m in zip(got.staged[0], want):
        assert n == held.sum() and right == ((m > 0) == (y > 0.5))[held].sum()
        assert np.isclose(loss, (np.logaddexp(0, m) - y * m)[held].sum(), rtol=1e-4)
    assert got.staged[1] == [] and len(got.staged[0]) == 4


def test_regression_equals_a_plain_loop(spark, df, rows):
    c = B.Candidate(depth=2, learning_rate=0.5, l2=1.0, bagging_temperature=0.0)
    model = B.boost(df, "x", "z", [B.Job(c)], "id", rounds=3, loss="squared", max_bins=6).models[0]
    want = brute(rows, model.borders, c, 3, "squared", label=3)[-1]
    assert np.allclose([r["s"] for r in df.select("id", model.score("x").alias("s")).orderBy("id").collect()], want, atol=1e-4)


def trees(model):
    return [(t.features, t.bins, np.round(t.values, 4).tolist()) for t in model.trees]


def test_a_model_does_not_depend_on_its_company(spark, df, monkeypatch):
    grid = [B.Candidate(d, r, l, t) for d in (2, 4) for r in (0.1, 0.3) for l in (1.0, 5.0) for t in (0.0, 1.0)]
    jobs = [B.Job(c, f) for c in grid for f in range(3)]
    whole = B.boost(df, "x", "y", jobs, "id", "fold", rounds=3)
    for i in (0, 17, 40):
        alone = B.boost(df.repartition(5, "id"), "x", "y", [jobs[i]], "id", "fold", rounds=3)
        assert trees(alone.models[0]) == trees(whole.models[i])
        assert np.allclose(alone.staged[0], whole.staged[i], atol=1e-3)
    monkeypatch.setattr(B, "BLOCK_ROWS", 100)
    monkeypatch.setattr(B, "CHECKPOINT_ROUNDS", 2)
    blocks = B.boost(df, "x", "y", jobs, "id", "fold", rounds=3)
    assert [[f for t in m.trees for f in t.features] for m in blocks.models] == [[f for t in m.trees for f in t.features] for m in whole.models]


def test_grid_search_refits_the_best(spark, df):
    grid = [B.Candidate(1, 0.001), B.Candidate(4, 0.3), B.Candidate(2, 0.05)]
    found = B.grid_search(df, "x", "y", "id", "fold", grid, rounds=12)
    assert len(found.trials) == 3 and found.best == grid[1] and [t["best"] for t in found.trials] == [0, 1, 0]
    majority = max(df.agg(F.avg("y")).first()[0], 1 - df.agg(F.avg("y")).first()[0])
    assert found.trials[1]["accuracy"] > majority + 0.1 and len(found.model.trees) == 12
    right = df.agg(F.avg(((found.model.score("x") > 0.5).cast("double") == F.col("y")).cast("double"))).first()[0]
    assert right >= found.trials[1]["accuracy"]


def test_halving_ends_bad_trials_early(spark, df):
    grid = [B.Candidate(3, 0.3), B.Candidate(1, 0.001), B.Candidate(3, 0.2), B.Candidate(1, 0.002)]
    got = B.cross_validate(df, "x", "y", "id", "fold", grid, rounds=9, halving=(2, 5))
    assert sorted(t["rounds"] for t in got) == [2, 2, 5, 9] and [t["rounds"] for t in got][1::2] == [2, 2]
    full = B.cross_validate(df, "x", "y", "id", "fold", grid, rounds=9)
    best = max(range(4), key=lambda i: got[i]["rounds"])
    assert np.isclose(got[best]["loss"], full[best]["loss"])
    assert min(t["loss"] for t in got) <= min(t["loss"] for t in full) + 1e-9


def test_staged_thresholds(spark, df, rows):
    model = B.boost(df, "x", "y", [B.Job(B.Candidate(2, 0.4))], "id", rounds=4).models[0]
    grid = [0.2, 0.4, 0.5, 0.7]
    table = B.staged_thresholds(df, model, "x", "y", grid).collect()
    assert len(table) == 16
    y = np.array([r[2] for r in rows])
    best = None
    for r in sorted(table, key=lambda r: (r["round"], r["threshold"])):
        p = np.array([q["s"] for q in df.select("id", model.score("x", r["round"]).alias("s")).orderBy("id").collect()]) if r["threshold"] == 0.2 else p
        hit = p > r["threshold"]
        tp, fp, fn = (hit & (y == 1)).sum(), (hit & (y == 0)).sum(), (~hit & (y == 1)).sum()
        assert (r["tp"], r["fp"], r["fn"]) == (tp, fp, fn) and np.isclose(r["f1"], 2 * tp / max(2 * tp + fp + fn, 1))
        assert np.isclose(r["logloss"], -np.mean(np.log(np.where(y == 1, p, 1 - p))))
        best = max([best, (r["f1"], -r["round"], -r["threshold"])] if best else [(r["f1"], -r["round"], -r["threshold"])])
    assert [(r["f1"], -r["round"], -r["threshold"]) for r in table if r["best"]] == [best]


def test_nothing_to_learn(spark, df):
    empty = B.boost(df.where("false"), "x", "y", [B.Job(B.Candidate(2))], "id", rounds=2)
    assert empty.models[0].trees == []
    flat = df.select("id", F.array(F.lit(1.0)).alias("x"), "y")
    assert B.boost(flat, "x", "y", [B.Job(B.Candidate(2))], "id", rounds=2).models[0].score("x") is not None
    gaps = df.withColumn("y", F.when(F.col("id") % 2 == 0, F.col("y")))
    model = B.boost(gaps, "x", "y", [B.Job(B.Candidate(2, 0.3))], "id", rounds=2).models[0]
    assert df.select(model.score("x").alias("s")).where("s is null or s <= 0 or s >= 1").count() == 0


@pytest.fixture(scope="module")
def coarse(spark):
    """3,000 rows in few cells, with keys of their own."""
    rng = np.random.default_rng(8)
    rows = [(i, [float(a), float(b), None if a == 3 else float(c)], float((a > 2) + b * c + rng.normal() > 1.5), i % 3)
            for i, (a, b, c) in enumerate(zip(rng.integers(0, 6, 3000), rng.integers(0, 2, 3000), rng.integers(0, 4, 3000)))]
    return spark.createDataFrame(rows, "id long, x array<double>, y double, fold int")


GRID = [B.Candidate(d, 0.3, 2.0, t) for d in (2, 4) for t in (0.0, 0.5, 1.0)]


def test_cells_and_blocks_grow_the_same_trees(spark, coarse, monkeypatch):
    jobs = [B.Job(c, f) for c in GRID for f in (0, None)]
    monkeypatch.setattr(B, "BLOCK_ROWS", 400)
    monkeypatch.setattr(B, "KEY_ROWS", 700)  # cells are cut between tasks
    monkeypatch.setattr(B, "WEIGHT_BYTES", 8 * 2 * 300)  # chunks of a few rounds
    cells = B.boost(coarse, "x", "y", jobs, "id", "fold", rounds=5)
    monkeypatch.setattr(B, "MAX_CELLS", 10)
    monkeypatch.setattr(B, "CHECKPOINT_ROUNDS", 2)
    blocks = B.boost(coarse, "x", "y", jobs, "id", "fold", rounds=5)
    for a, b in zip(cells.models, blocks.models):
        assert [(t.features, t.bins) for t in a.trees] == [(t.features, t.bins) for t in b.trees] and len(a.trees) == 5
        assert all(np.allclose(t.values, u.values, atol=1e-5) for t, u in zip(a.trees, b.trees))
    for a, b in zip(cells.staged, blocks.staged):
        assert len(a) == len(b) and np.allclose(a, b, rtol=1e-4) if a or b else a == b
    ends = B.cross_validate(coarse, "x", "y", "id", "fold", GRID, rounds=5, halving=(2, 4))
    monkeypatch.setattr(B, "MAX_CELLS", 1 << 17)
    again = B.cross_validate(coarse, "x", "y", "id", "fold", GRID, rounds=5, halving=(2, 4))
    assert [t["rounds"] for t in ends] == [t["rounds"] for t in again] and sorted(t["rounds"] for t in ends) == [2, 2, 2, 4, 5, 5]


def test_jobs_and_trained_rows_do_not_grow_with_the_rows(spark, coarse, monkeypatch):
    sizes, jobs = [], []
    grow, tracker = B._boost_cells, spark.sparkContext.statusTracker()

    def seen(blocks, codes, n, *args):
        sizes.append((len(codes), int(n.sum())))
        return grow(blocks, codes, n, *args)
    monkeypatch.setattr(B, "_boost_cells", seen)
    monkeypatch.setattr(B, "BLOCK_ROWS", 500)
    tenfold = coarse.crossJoin(spark.range(10).withColumnRenamed("id", "k")).withColumn("id", F.col("id") * 10 + F.col("k"))
    for df in (coarse, tenfold):
        group = f"boost-{df.count()}"
        spark.sparkContext.setJobGroup(group, group)
        B.boost(df, "x", "y", [B.Job(B.Candidate(4), 0)], "id", "fold", rounds=10)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs.append(len(tracker.getJobIdsForGroup(group)))
    assert sizes[0][0] == sizes[1][0] <= 6 * 2 * 4 * 2 * 3 and [n for _, n in sizes] == [3000, 30000]
    assert max(jobs) < 25  # not one job per round and level


def test_a_holdout_in_one_task_is_scored_by_many(spark, df):
    model = B.boost(df, "x", "y", [B.Job(B.Candidate(2, 0.4))], "id", rounds=2).models[0]
    table = B.staged_thresholds(df.coalesce(1), model, "x", "y", [0.4, 0.5])
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert f"RoundRobinPartitioning({spark.sparkContext.defaultParallelism})" in plan
    assert table.count() == 4
