"""Readers on written files; models and filters against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronopix.operators import linalg, spatial, trends
from chronopix.sources import files

FOLDER = "/root/testdata/sf0.001"


def test_raw_frames(spark, tmp_path):
    rng = np.random.default_rng(1)
    stack = rng.integers(0, 65536, (7, 3, 4 * 5, 2)).astype("<u2")  # time, plane, pixel, channel
    path = tmp_path / "recording.raw"
    path.write_bytes(stack.tobytes())
    got = files.raw_frames(spark, str(path), 5, 4, channels=2, planes=3, kept_planes=2).collect()
    assert len(got) == 7 * 2 * 2
    for r in got:
        assert r["values"] == stack[r.frame, r.plane, :, r.channel].tolist()


def test_centres_and_manifest(spark, tmp_path):
    rows = [(0, 12, 7), (1, 100, 200), (2, 12, 7)]
    path = str(tmp_path / "centres")
    files.write_centres(spark.createDataFrame(rows, "idx int, y int, x int"), path)
    assert sorted(map(tuple, files.read_centres(spark, path).collect())) == rows[:2]
    assert sorted(map(tuple, files.read_centres(spark, path, distinct=False).collect())) == rows
    assert {r.line for r in files.manifest(spark, path).collect()} == {"0:  12,   7", "1: 100, 200", "2:  12,   7"}
    (tmp_path / "list").write_text(" a \n\n b\n")
    assert sorted(r.line for r in files.manifest(spark, str(tmp_path / "list"), remove_empty=False).collect()) == ["", "a", "b"]


def test_blur_and_closing_at_borders(spark):
    x = np.random.default_rng(2).random((5, 6)).round(3)
    df = spark.createDataFrame([(0, int(y), int(c), float(x[y, c])) for y in range(5) for c in range(6)], "frame int, y int, x int, value double")
    one = spatial.framed(df, ["frame"], 6)
    w = spatial.gaussian_weights(1.0, 2.0)
    wide = np.pad(x, 2, mode="symmetric")
    want = sum(a * b * wide[i : i + 5, j : j + 6] for i, a in enumerate(w) for j, b in enumerate(w))
    got = np.array(one.select(spatial.blurred(F.col("image"), 5, 6, 1.0, 2.0).alias("v")).first()["v"])
    assert np.allclose(got, want.ravel())
    closed = np.array(one.select(spatial.closed(F.col("image"), 5, 6, 1).alias("v")).first()["v"])
    assert (closed >= x.ravel()).all() and closed.max() == x.max()


def test_isotonic_is_the_least_squares_fit():
    rng = np.random.default_rng(3)
    for n in (1, 2, 17, 60):
        v = rng.normal(size=n).round(2) + np.arange(n) * 0.05
        upto = np.concatenate([[0], np.cumsum(v)])
        want = [max(min((upto[j + 1] - upto[i]) / (j - i + 1) for j in range(t, n)) for i in range(t + 1)) for t in range(n)]
        assert np.allclose(trends.isotonic(v), want)


def test_pauses(spark):
    rows = [(t, x) for t in (1, 2) for x in (0, 3, 6, 7, 13, 14, 30)]
    got = trends.with_pause(spark.createDataFrame(rows, "trial_id long, frame long"), "frame", 5).collect()
    assert sorted(map(tuple, got)) == [(t, x) for t in (1, 2) for x in (0, 6, 13, 30)]


def test_axes_and_ratios_against_numpy(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 3)) * [3, 1, 0.3] + np.where(np.arange(60)[:, None] % 2, [1, 2, 0], 0)
    df = spark.createDataFrame([(bool(i % 2), i // 30, [float(v) for v in r]) for i, r in enumerate(x)], "state boolean, half int, v array<double>")
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    axes = linalg.principal_axes(df, "v").toPandas()
    assert np.allclose(sorted(axes["variance"].unique()), values)
    for k, i in enumerate(np.argsort(-values)):
        weights = axes[axes["axis"] == k].sort_values("feature")["weight"].to_numpy()
        assert np.isclose(abs(weights @ vectors[:, i]), 1)
    a, b = x[1::2], x[::2]
    w = np.linalg.solve((len(a) * np.cov(a.T, bias=True) + len(b) * np.cov(b.T, bias=True)) / 60, a.mean(0) - b.mean(0))
    got = linalg.discriminant_axis(df, "v", F.col("state")).toPandas().sort_values("feature")["weight"].to_numpy()
    assert np.allclose(got, w / np.linalg.norm(w))

    z = (x - x.mean(0)) / x.std(0)

    def between(p, q):
        both = np.vstack([p, q])
        inner = (len(p) * np.cov(p.T, bias=True) + len(q) * np.cov(q.T, bias=True)) / len(both)
        return np.linalg.norm(np.cov(both.T, bias=True) - inner) / 3

    on, first = np.arange(60) % 2 == 1, np.arange(60) < 30
    states = between(z[on], z[~on])
    times = [between(z[s & first], z[s & ~first]) * s.sum() / 60 for s in (on, ~on)]
    r = linalg.variance_ratios(df, "v", "state", "half").first()
    assert np.allclose([r.ratio, r.between_states, r.first_in_time, r.other_in_time], [sum(times) / states, states, *times])


def test_nested_ridge_against_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 2))
    y = x @ [1.0, -2.0] + rng.normal(size=200) * 0.5
    outer, inner = rng.integers(0, 3, 200), rng.integers(0, 4, 200)
    alphas = [0.01, 1.0, 100.0]
    df = spark.createDataFrame([(*map(float, r), float(t), int(o), int(i)) for r, t, o, i in zip(x, y, outer, inner)], "a double, b double, y double, o int, i int")
    got = {r.fold: r for r in linalg.ridge_nested(df, ["a", "b"], "y", "o", "i", alphas).collect()}
    fit = lambda s, k: np.linalg.solve(x[s].T @ x[s] + k * np.eye(2), x[s].T @ y[s])
    explained = lambda w, s: 1 - np.var(y[s] - x[s] @ w) / np.var(y[s])
    for o in range(3):
        train = outer != o
        best = max(alphas, key=lambda k: np.mean([explained(fit(train & (inner != i), k), train & (inner == i)) for i in range(4)]))
        assert got[o].alpha == best and np.isclose(got[o].var_explained, explained(fit(train, best), ~train))


def test_sampling_keeps_whole_rows(spark):
    from chronopix import registry

    registry.load()
    f = spark.read.parquet(f"{FOLDER}/events.parquet").count()
    assert 0 < registry.QUERIES["weighted_sample"](spark, FOLDER).count() <= f
    assert registry.QUERIES["shuffle_cols"](spark, FOLDER).count() > 0


def test_labels_of_many_trials(spark, tmp_path):
    """Whatever the names and texts; other readers of tables see the same. Each folder was one for the driver."""
    trials = ["a", "b/c:1", "100%", "x y", "ü", "[z]", "", None] + [f"t{i}" for i in range(40)]
    texts = ["one", 'said "no", twice', "", None, "a b", "ö"]
    rows = [(t, i, x) for t in trials for i, x in enumerate(texts)]
    path = str(tmp_path / "labels")
    files.write_labels(spark.createDataFrame(rows, "trial string, frame long, label string").repartition(5), path, "trial")
    got = files.read_labels(spark, path, "frame long, label string", "trial")
    key = lambda r: tuple(map(str, r))
    want = sorted(((t or None, i, x or None) for t, i, x in rows), key=key)  # as CSV has it
    assert sorted(map(tuple, got.collect()), key=key) == want
    assert not any(path in f for f in got.inputFiles()) and got.rdd.getNumPartitions() < 10
    usual = spark.read.schema("frame long, label string, trial string").option("header", "true").csv(path).select("trial", "frame", "label")
    assert sorted(map(tuple, usual.collect()), key=key) == want
    with pytest.raises(FileExistsError):
        files.write_labels(spark.createDataFrame(rows, "trial string, frame long, label string"), path, "trial")


def test_labels_of_a_long_trial(spark, tmp_path, monkeypatch):
    """In ranges of bytes, wherever they end."""
    from chronopix.sources import stores

    path = str(tmp_path / "labels")
    files.write_labels(spark.range(1000).select(F.lit(7).alias("trial_id"), F.col("id").alias("frame"), F.repeat(F.lit("x"), (F.col("id") % 5 + 1).cast("int")).alias("label")), path)
    for split in (1, 13, 1000):
        monkeypatch.setattr(stores, "SPLIT", split if split > 1 else 3)
        got = files.read_labels(spark, path, "frame long, label string", kind="int")
        assert sorted(map(tuple, got.collect())) == [(7, i, "x" * (i % 5 + 1)) for i in range(1000)]
