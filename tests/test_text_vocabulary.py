"""The vocabulary by hash counters against a direct count."""

import random
from collections import Counter

import pytest

from gristmill.operators import text as X


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    rows = [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 60)))) for i in range(300)] + [(300, None), (301, ""), (302, "a b c")]
    return spark.createDataFrame(rows, "id long, text string"), rows


def brute(rows, size):
    freq, df = Counter(), Counter()
    for _, t in rows:
        ws = [w for w in (t or "").split() if len(w) > 1]
        grams = ws + [f"{a} {b}" for a, b in zip(ws, ws[1:])]
        freq.update(grams)
        df.update(set(grams))
    return [(t, n, df[t]) for t, n in sorted(freq.items(), key=lambda x: (-x[1], x[0]))[:size]]


@pytest.mark.parametrize("size, counters", [(5, 1 << 14), (40, 1 << 14), (40, 64), (300, 1 << 12), (5, 8), (10**6, 1 << 12)])
def test_top_terms(corpus, size, counters):
    frame, rows = corpus
    got = X.top_terms(X.gram_rows(frame, "text"), size, counters).collect()
    assert sorted(((r["term"], r["freq"], r["df"]) for r in got), key=lambda x: (-x[1], x[0])) == brute(rows, size)


def test_second_recount_finds_what_light_counters_hide(spark):
    # few heavy counters, and many terms of one frequency spread over all counters
    rows = [(i, " ".join(f"t{i}x{k}" for k in range(20))) for i in range(30)]
    frame = spark.createDataFrame(rows, "id long, text string")
    got = X.top_terms(X.gram_rows(frame, "text"), 30, 4096).collect()
    assert [(r["term"], r["freq"], r["df"]) for r in sorted(got, key=lambda r: (-r["freq"], r["term"]))] == brute(rows, 30)


def test_weights_do_not_depend_on_the_way_of_counting(corpus):
    frame, _ = corpus
    rows = [{(r["id"], r["term"]): round(r["weight"], 9) for r in X.TfidfLong("id", "text", 50, direct_terms=d).fit(frame).transform(frame).collect()}
            for d in (10**9, 0)]
    assert rows[0] == rows[1] and len({t for _, t in rows[0]}) == 50


def test_transform_shuffles_once(corpus):
    frame, _ = corpus
    out = X.TfidfLong("id", "text", 50).fit(frame).transform(frame)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
