"""Groups that tasks hold many of."""

import numpy as np
import pyarrow as pa
import pytest

from chronopix.operators import groups


@pytest.mark.parametrize("rows", [1, 3, 10, 10**6])
def test_groups_stay_whole(monkeypatch, rows):
    """Wherever batches end, with keys that are null."""
    monkeypatch.setattr(groups, "ROWS", rows)
    rng = np.random.default_rng(1)
    key = sorted(rng.integers(0, 12, 60).tolist())
    whole = pa.record_batch({"a": pa.array([None if k == 5 else k for k in key]), "b": pa.array([k % 2 for k in key]), "v": pa.array(range(60))})
    for cut in (1, 7, 60):
        got = []
        for batch, bounds in groups.whole_groups((whole[i : i + cut] for i in range(0, 60, cut)), ["a", "b"]):
            assert bounds[0] == 0 and bounds[-1] == batch.num_rows
            got += [batch.column("v")[a:b].to_pylist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        assert got == [[i for i, x in enumerate(key) if x == k] for k in sorted(set(key))]
    assert list(groups.whole_groups(iter([]), ["a"])) == []
