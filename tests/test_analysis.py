"""Operators over frames and recordings against plain NumPy, and tables written in parts."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chronopix.operators import align, clusters, framewise, selection, wavelets
from chronopix.sources import sinks


def stack_of(spark, x):
    """(trials, frames, y, x) as rows."""
    rows = [(t, f, i, j, float(v)) for (t, f, i, j), v in np.ndenumerate(x)]
    return spark.createDataFrame(rows, "trial_id int, frame long, y int, x int, value double")


# wavelets


def plain_amplitudes(x, rate, of):
    n, out = np.arange(len(x)), []
    for f in of:
        s = wavelets.spread(f)
        t = (n[None] - n[:, None]) / rate / s
        out.append(np.abs(wavelets.factor(f, rate) * (x[None] * np.exp(-0.5 * t * t - 1j * wavelets.CYCLES * t)).sum(1)))
    return np.stack(out, 1)


@pytest.mark.parametrize("piece", [300, 1000, 100_000])
def test_wavelets_in_pieces(spark, piece):
    """However a recording is cut, its coefficients are the same."""
    rng = np.random.default_rng(1)
    x = {1: rng.normal(size=1500), 2: np.sin(np.arange(700) / 100 * 2 * np.pi * 9.0), 3: np.zeros(4), 4: rng.normal(size=1)}
    rows = [(t, i, float(v), float(v) * 2 + 1) for t, values in x.items() for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "trial_id long, frame long, a double, b double")
    got = {(r.trial_id, r.frame): r for r in wavelets.wavelet_features(df, "trial_id", "frame", ["a", "b"], piece=piece).collect()}
    assert len(got) == len(rows)
    of = wavelets.frequencies(25, 1.0, 50.0)
    for t, values in x.items():
        want = np.concatenate([plain_amplitudes(v, 100.0, of) for v in (values, values * 2 + 1)], 1)
        power = want.sum(1)
        assert np.allclose([got[t, i].power for i in range(len(values))], power, atol=1e-7)
        assert np.allclose([got[t, i]["share"] for i in range(len(values))], want / power[:, None], atol=1e-7)
    peak = plain_amplitudes(x[2], 100.0, of)[350].argmax()
    assert abs(of[peak] - 9.0) < 1.0


def test_wavelets_of_what_is_missing(spark):
    df = spark.createDataFrame([(1, 0, None), (1, 1, float("nan")), (1, 2, float("inf"))], "trial_id long, frame long, a double")
    got = wavelets.wavelet_features(df, "trial_id", "frame", ["a"]).collect()
    assert len(got) == 3 and all(r.power == 0 and set(r["share"]) == {0.0} for r in got)
    assert wavelets.wavelet_features(df.where("false"), "trial_id", "frame", ["a"]).count() == 0


def test_many_short_signals_are_transformed_at_once(spark, monkeypatch):
    """Each was transformed for itself, at the length of the longest wavelet."""
    size, kernels, halves = wavelets.spectra(100.0, wavelets.frequencies(25, 1.0, 50.0), 64)
    assert size <= 256 and max(halves) == 63
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 64))
    monkeypatch.setattr(wavelets, "AT_ONCE", 256 * 25 * 7)
    got = wavelets.amplitudes(x, 100.0, wavelets.frequencies(25, 1.0, 50.0))
    assert all(np.allclose(got[i], plain_amplitudes(x[i], 100.0, wavelets.frequencies(25, 1.0, 50.0)), atol=1e-9) for i in range(40))


# moments and clusters


def plain_linkage(apart):
    """Of all pairs of clusters the nearest, again and again."""
    groups, heights = {i: [i] for i in range(len(apart))}, []
    while len(groups) > 1:
        far = lambda a, b: max(apart[i, j] for i in groups[a] for j in groups[b])
        a, b = min(((a, b) for a in groups for b in groups if a < b), key=lambda p: far(*p))
        heights.append((far(a, b), frozenset(groups[a] + groups[b])))
        groups[a] += groups.pop(b)
    return heights


def test_complete_linkage():
    rng = np.random.default_rng(2)
    for n in (2, 3, 9, 30):
        apart = clusters.distances(rng.normal(size=(n, 3)))
        merges = clusters.complete_linkage(apart)
        members = [[i] for i in range(n)]
        got = []
        for a, b, height in merges:
            members.append(members[a] + members[b])
            got.append((height, frozenset(members[-1])))
        want = plain_linkage(apart)
        assert np.allclose([h for h, _ in got], [h for h, _ in want]) and {m for _, m in got} == {m for _, m in want}
        for height in (0.0, apart.max() / 2, apart.max()):
            numbers = clusters.cut(n, merges, height)
            groups = [frozenset(i for i in range(n) if numbers[i] == k) for k in set(numbers)]
            below = [m for h, m in want if h <= height]
            assert set(groups) == {g for g in [*below, *[frozenset([i]) for i in range(n)]] if not any(g < m for m in below)}
            assert sorted(set(numbers)) == list(range(1, len(groups) + 1))


def test_features_in_order_of_their_clusters(spark):
    """Three kinds of features, mixed up: each kind ends up together."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(400, 3)) * [3, 5, 8]
    kinds = rng.integers(0, 3, 20)
    v = base[:, kinds] + rng.normal(size=(400, 20)) * 0.1
    df = spark.createDataFrame([(row.tolist(),) for row in v] + [(None,), ([None] * 20,)], "v array<double>")
    got = sorted(clusters.cluster_order(df, "v").collect(), key=lambda r: r.place)
    assert sorted(r.feature for r in got) == list(range(20)) and [r.cluster for r in got] == sorted(r.cluster for r in got)
    assert len({(kinds[r.feature], r.cluster) for r in got}) == len(set(kinds))
    assert clusters.cluster_order(df.where("v[0] > 1e9"), "v").count() == 0


def test_moments(spark):
    rng = np.random.default_rng(4)
    v, keys = rng.normal(size=(300, 5)), rng.integers(0, 3, 300)
    df = spark.createDataFrame([(int(k), row.tolist()) for k, row in zip(keys, v, strict=True)], "k int, v array<double>")
    got = clusters.moments(df, "v", "k")
    for k in range(3):
        x = v[keys == k]
        assert got[k].n == len(x) and np.allclose(got[k].mean, x.mean(0)) and np.allclose(got[k].covariance, np.cov(x.T, bias=True))
    both = got[0] + got[1]
    assert np.allclose(both.covariance, np.cov(v[keys < 2].T, bias=True))
    z = both.standardised(both.mean, np.sqrt(np.diag(both.covariance)))
    assert np.allclose(z.mean, 0) and np.allclose(z.covariance, np.corrcoef(v[keys < 2].T))


# frames


def test_filters_of_frames():
    rng = np.random.default_rng(5)
    x = rng.random((3, 6, 7)).round(2)
    wide = np.pad(x, ((0, 0), (2, 2), (2, 2)), constant_values=-np.inf)
    squares = np.array([[[wide[n, i : i + 5, j : j + 5].max() for j in range(7)] for i in range(6)] for n in range(3)])
    assert np.array_equal(framewise.box_maxima(x, 2), squares)
    mask = (x > 0.3).astype(float)
    for n in range(3):
        for i in range(6):
            for j in range(7):
                around = [mask[n, i + a, j + b] for a, b in framewise.disk(1) if 0 <= i + a < 6 and 0 <= j + b < 7]
                assert framewise.eroded(mask, 1)[n, i, j] == min(around)
    assert np.array_equal(framewise.eroded(mask, 0), mask)
    assert (framewise.closed(x, 2) >= x).all()


def test_motion_fields(spark):
    """A field of whole pixels shifts, and one of halves is the mean of two."""
    x = np.random.default_rng(6).random((1, 3, 4, 5))
    stack = framewise.frames_of(stack_of(spark, x), ["trial_id", "frame"], 5, ["value"]).withColumnRenamed("value", "image")
    fields = spark.createDataFrame([(0, 0, [1.0] * 20, [0.0] * 20), (0, 1, [0.0] * 20, [0.5] * 20), (0, 2, [-9.0] * 20, [99.0] * 20)], "trial_id int, frame long, right array<double>, down array<double>")
    got = {r.frame: np.array(r.image).reshape(4, 5) for r in framewise.apply_motion_field(stack, fields, ["trial_id", "frame"], 4, 5).collect()}
    assert np.allclose(got[0], x[0, 0][:, [1, 2, 3, 4, 4]])
    assert np.allclose(got[1], (x[0, 1] + x[0, 1][[1, 2, 3, 3]]) / 2)
    assert np.allclose(got[2], x[0, 2, 3, 0])
    with pytest.raises(Exception, match="reshape"):
        framewise.apply_motion_field(stack, fields, ["trial_id", "frame"], 4, 6).collect()


def test_resized_frames():
    x = np.random.default_rng(7).random((2, 4, 6))
    assert np.allclose(framewise.resized(x, 4, 6), x)
    assert np.allclose(framewise.resized(x, 2, 3), (x[:, ::2, ::2] + x[:, 1::2, ::2] + x[:, ::2, 1::2] + x[:, 1::2, 1::2]) / 4)
    flat = np.full((1, 3, 3), 2.5)
    assert np.allclose(framewise.resized(flat, 128, 77), 2.5)


def test_selection_maps(spark):
    """Two groups of pixels that follow two signals are told apart by the first two maps."""
    rng = np.random.default_rng(8)
    signal = rng.normal(size=(2, 200, 2)) * [2.0, 1.5]
    x = rng.normal(size=(2, 200, 12, 12)) * 0.05
    x[:, :, 2:6, 2:6] += signal[:, :, 0, None, None]
    x[:, :, 8:11, 8:11] += signal[:, :, 1, None, None]
    df = stack_of(spark, x)
    deviation = df.groupBy("trial_id", "y", "x").agg(F.stddev_pop("value").alias("s")).groupBy("y", "x").agg(F.avg("s").alias("std"))
    mask = selection.selection_mask(deviation, 12, 12, local=4.0, smooth=1.0, reach=0)
    inside = {(r.y, r.x) for r in mask.collect() if r.inside}
    blocks = [{(i, j) for i in range(a, b) for j in range(a, b)} for a, b in ((2, 6), (8, 11))]
    assert inside <= blocks[0] | blocks[1] and all(len(inside & b) > 3 for b in blocks)
    rows = selection.selection_maps(df, deviation, mask, n=20, maps=2).collect()
    assert len(rows) == 2 * 144
    maps = np.zeros((2, 12, 12))
    for r in rows:
        maps[r.map, r.y, r.x] = r.weight
    assert (maps[0] != 0).sum() == min(20, len(inside))
    strong = lambda k, b: sum(maps[k, i, j] ** 2 for i, j in b)
    assert abs(strong(0, blocks[0]) - strong(0, blocks[1])) > 0.9 and abs(strong(1, blocks[0]) - strong(1, blocks[1])) > 0.9
    same = selection.selection_maps(df.repartition(7), deviation, mask, n=20, maps=2).collect()
    key = lambda r: (r.map, r.y, r.x)
    assert np.allclose([r.weight for r in sorted(rows, key=key)], [r.weight for r in sorted(same, key=key)])


def test_offsets_are_kept(spark, tmp_path):
    x = np.zeros((2, 2, 8, 8))
    x[:, :, 5:7, 2:4] = 1.0
    df, path = stack_of(spark, x), str(tmp_path / "offsets")
    args = (path, 8, 8, (0, 8, 0, 8))
    options = {"sigma": 0.5, "truncate": 2.0, "quantile": 0.75, "corner": 2}
    one, two = framewise.centred_and_cropped(df, df.withColumn("value", -F.col("value")), *args, **options)
    offsets = {(r.trial_id, r.frame): (r.dy, r.dx) for r in spark.read.parquet(path).collect()}
    assert set(offsets.values()) == {(1, -1)} and len(offsets) == 4
    image = np.zeros((8, 8))
    for r in one.where("trial_id = 0 and frame = 0").collect():
        image[r.y, r.x] = r.value
    assert image[4:6, 3:5].min() == 1.0 and image.sum() == 4.0
    assert {-r.value for r in two.collect()} == {r.value for r in one.collect()}
    # another stack of the same trials moves as the kept offsets say
    other = stack_of(spark, np.roll(x, 3, axis=3))
    again, _ = framewise.centred_and_cropped(other, None, *args, **options)
    assert {(r.trial_id, r.frame): (r.dy, r.dx) for r in spark.read.parquet(path).collect()} == offsets
    assert {(r.y, r.x) for r in again.where("trial_id = 0 and frame = 0 and value = 1").collect()} == {(i, j) for i in (4, 5) for j in (6, 7)}


# parts


def files_of(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_only_missing_parts_are_written(spark, tmp_path):
    path = str(tmp_path / "parts")
    df = spark.createDataFrame([(t, f, t * 100 + f) for t in range(3) for f in range(8)], "trial_id int, frame long, value long")
    parts = framewise.parted(df, 3)
    assert sorted((r.part, r.frame) for r in parts.where("trial_id = 0").collect()) == [(f // 3, f) for f in range(8)]
    assert sinks.write_missing(parts, path, ["trial_id", "part"]) == 9
    first = files_of(path)
    assert sinks.write_missing(parts, path, ["trial_id", "part"]) == 0 and files_of(path) == first
    # a part that was lost, and one that was written by half
    lost = [f for f in first if "trial_id=1/part=2" in f]
    half = [f for f in first if "trial_id=2/part=0" in f]
    for f in lost + half:
        os.remove(f)
    spark.createDataFrame([(0, 0)], "frame long, value long").write.mode("overwrite").parquet(os.path.dirname(half[0]))
    assert sinks.write_missing(parts, path, ["trial_id", "part"], expected=parts.select("trial_id", "part")) == 2
    kept = {f: t for f, t in files_of(path).items() if f in first}
    assert kept == {f: t for f, t in first.items() if f not in lost + half}
    assert sorted((r.trial_id, r.frame, r.value) for r in spark.read.parquet(path).collect()) == sorted(map(tuple, df.collect()))
    assert sinks.write_missing(parts, path, ["trial_id", "part"], overwrite=True) == 9
    assert sinks.write_missing(parts.where("false"), path, ["trial_id", "part"]) == 0


# reducers


def test_one_call_reduces_many_groups(spark):
    """Each group was a call of its own, and groups of several columns were joined; keys may be null."""
    rows = [(None if i % 5 == 0 else i % 5, i // 50, float("nan") if i == 7 else float(i)) for i in range(1000)]
    df = spark.createDataFrame(rows, "trial_id long, slow_index long, a double").withColumn("b", F.col("a"))
    own = {"a": align.Reducer("long", whole=lambda v: len(v)), "b": align.Reducer("long", partial=lambda v: [float(len(v))], finish=lambda s: int(s[0]))}
    got = align.reduce_by(df, own)
    assert "AggregateInPandas" not in (plan := got._jdf.queryExecution().toString()) and "ArrowAggregate" not in plan
    assert {(r.trial_id, r.slow_index): (r.a, r.b) for r in got.collect()} == {(t or None, s): (10, 9 if (t, s) == (2, 0) else 10) for t in range(5) for s in range(20)}


def test_own_reducers(spark):
    rows = [(1, i % 3 if i % 7 else None, float(i)) for i in range(500)] + [(2, 0, None), (2, 1, 4.0), (2, 1, None)]
    df = spark.createDataFrame(rows, "trial_id long, slow_index long, a double").repartition(5).withColumn("b", F.col("a")).withColumn("c", F.col("a"))
    spread = align.Reducer("double", partial=lambda v: [float(len(v)), float(v.sum()), float((v * v).sum())], finish=lambda s: (s[2] / s[0] - (s[1] / s[0]) ** 2) ** 0.5)
    reach = align.Reducer("string", partial=lambda v: [float(v.min()), float(v.max())], merge=lambda a, b: [min(a[0], b[0]), max(a[1], b[1])], finish=lambda s: f"{s[0]:.0f}-{s[1]:.0f}")
    third = align.Reducer("double", whole=lambda v: float(np.sort(v)[len(v) // 3]))
    got = {(r.trial_id, r.slow_index): r for r in align.reduce_by(df, {"a": spread, "b": reach, "c": third}).collect()}
    groups = pd.DataFrame([r for r in rows if r[1] is not None], columns=["t", "s", "a"]).groupby(["t", "s"])["a"]
    assert set(got) == set(groups.groups)
    for own, v in groups:
        v, r = v.dropna(), got[own]
        if len(v):
            assert abs(r.a - v.std(ddof=0)) < 1e-9 and r.b == f"{v.min():.0f}-{v.max():.0f}" and r.c == np.sort(v)[len(v) // 3]
        else:
            assert (r.a, r.b, r.c) == (None, None, None)
