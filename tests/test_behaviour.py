"""Maps of columns between clocks, scores of classes, and random operators' results."""

import numpy as np
from pyspark.sql import functions as F

from chronopix.functions.scalar import cohort_condition, joined_each
from chronopix.operators import align, linalg, ordering, scoring


def test_columns_by_a_map(spark):
    """Rows of the slow clock without fast ones get nothing's value; unknown columns are skipped."""
    slow = spark.createDataFrame([(1, i) for i in range(3)] + [(2, 0)], "trial_id long, slow_index long")
    fast = spark.createDataFrame([(1, 0, 0, 2.0, True, "a"), (1, 0, 1, 4.0, False, "b"), (1, 2, 2, None, None, None), (1, None, 3, 9.0, True, "z")], "trial_id long, slow_index long, frame long, v double, on boolean, s string")
    columns = {"v": ("velocity", "mean"), "on": ("stimulus", "any"), "s": ("odour", "first_last"), "gone": ("x", "max")}
    got = align.mapped_groups(slow, fast, columns)
    assert got.columns == ["trial_id", "slow_index", "velocity", "stimulus", "odour"]
    assert sorted(map(tuple, got.collect())) == [(1, 0, 3.0, True, "ab"), (1, 1, 0.0, False, ""), (1, 2, 0.0, False, ""), (2, 0, 0.0, False, "")]


def test_scores_of_classes(spark):
    rng = np.random.default_rng(1)
    x, label = rng.normal(size=(60, 4)), rng.integers(0, 3, 60)
    rows = [(i, f"c{k}", v.tolist()) for i, (k, v) in enumerate(zip(label, x, strict=True))] + [(100, None, [1.0] * 4), (101, "c1", None)]
    df = spark.createDataFrame(rows, "i long, label string, v array<double>")
    model = scoring.class_means(df, "v", "label")
    means = np.stack([x[label == k].mean(0) for k in range(3)])
    assert model.classes == ["c0", "c1", "c2"] and np.allclose(model.weights, means)
    got = {r.i: r for r in scoring.scored(df, "v", model, sharpness=2.0).collect()}
    e = np.exp(2 * x @ means.T)
    p = e / e.sum(1, keepdims=True)
    for i in range(60):
        assert np.allclose(got[i].probabilities, p[i]) and got[i].prediction == f"c{p[i].argmax()}" and np.isclose(got[i].entropy, -(p[i] * np.log(p[i])).sum())
    assert (got[101].prediction, got[101].entropy, got[101].probabilities) == (None, None, None) and got[100].prediction
    none = scoring.class_means(df.where("false"), "v", "label")
    assert none.classes == [] and scoring.scored(df.where("false"), "v", model).count() == 0


def test_ridge_by_key(spark):
    rng = np.random.default_rng(2)
    x, keys = rng.normal(size=(90, 3)), rng.integers(0, 3, 90)
    y = x @ [1.0, -2.0, 0.5] + rng.normal(size=90)
    df = spark.createDataFrame([(int(k), *map(float, r), float(t)) for k, r, t in zip(keys, x, y, strict=True)] + [(9, 1.0, 1.0, 1.0, 1.0)], "k long, a double, b double, c double, y double")
    weights = linalg.ridge_weights(df, ["a", "b", "c"], "y", 0.7, "k")
    got = {r.k: r.weights for r in weights.collect()}
    for k in range(3):
        own = x[keys == k]
        assert np.allclose(got[k], np.linalg.solve(own.T @ own + 0.7 * np.eye(3), own.T @ y[keys == k]))
    assert linalg.ridge_weights(df.where("k = 9"), ["a", "b", "c"], "y", 0.0, "k").first().weights is None
    fitted = linalg.ridge_predict(df, ["a", "b", "c"], weights, "k").where("k < 9").collect()
    assert all(np.isclose(r.fitted, np.dot(got[r.k], [r.a, r.b, r.c])) for r in fitted)


def test_conditions_and_paths(spark):
    df = spark.createDataFrame([("low caff, high caffeine", ["a", "b/c"]), ("starved sucr", []), ("fed", None), (None, ["x"])], "notes string, paths array<string>")
    got = df.select(cohort_condition(F.col("notes")).alias("c"), joined_each(F.col("paths"), "d", "e").alias("p")).collect()
    assert [(r.c, r.p) for r in got] == [("high caffeine", ["a/d/e", "b/c/d/e"]), ("sucrose", []), ("", None), ("", ["x/d/e"])]


def test_shuffled_columns_keep_their_values(spark):
    """Within a trial the same values stand in another order; other trials' don't come in."""
    rows = [(t, f, float(t * 1000 + f)) for t in range(3) for f in range(200)]
    df = spark.createDataFrame(rows, "trial_id long, frame long, value double")
    got = ordering.shuffled(df, "value", 7).collect()
    assert len(got) == 600 and sorted((r.trial_id, r.frame, r.value) for r in got) == rows
    for t in range(3):
        own = sorted((r.frame, r.value_shuffled) for r in got if r.trial_id == t)
        values = [v for _, v in own]
        assert sorted(values) == [float(t * 1000 + f) for f in range(200)]
        assert sum(v == t * 1000 + f for f, v in own) < 20 and abs(np.corrcoef(range(200), values)[0, 1]) < 0.3


def test_weighted_samples(spark):
    """Without replacement, never a weight of nothing, and heavy rows far more often."""
    rows = [(i, 0.0 if i < 10 else 50.0 if i < 30 else 1.0) for i in range(1030)]
    df = spark.createDataFrame(rows, "i long, w double").repartition(4)
    heavy = 0
    for seed in range(5):
        got = [r.i for r in ordering.weighted_sample(df, "w", 100, seed).collect()]
        assert len(got) == len(set(got)) == 100 and min(got) >= 10
        heavy += sum(10 <= i < 30 for i in got)
    assert heavy >= 80  # 20 of 1020 rows hold half of the weight
    assert ordering.weighted_sample(df, "w", 5000, 1).count() == 1020
