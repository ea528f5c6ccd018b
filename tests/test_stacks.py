"""Axes over all components of the embeddings, against numpy."""

import numpy as np

from chronopix import registry

registry.load()
FOLDER = "/root/testdata/sf0.001"


def test_axes_take_all_components(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    x, first = np.array([r.embedding for r in rows], float), np.array([r.label < 5 for r in rows])
    got = registry.QUERIES["pca"](spark, FOLDER).toPandas()
    assert len(got) == 64 * 64 and set(got.feature) == {f"f{i}" for i in range(64)}
    np.testing.assert_allclose(got.groupby("axis").variance.first(), np.sort(np.linalg.eigvalsh(np.cov(x.T, bias=True)))[::-1], rtol=1e-9)
    axis = registry.QUERIES["lda_axis"](spark, FOLDER).toPandas().set_index("feature").weight
    inside = sum(k.sum() * np.cov(x[k].T, bias=True) for k in (first, ~first)) / len(x)
    w = np.linalg.solve(inside, x[first].mean(0) - x[~first].mean(0))
    np.testing.assert_allclose([axis[f"f{i}"] for i in range(64)], w / np.linalg.norm(w), atol=1e-9)
