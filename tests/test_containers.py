"""Containers of lines and tracks: any shapes and chunks, ranges of ticks, what may be missing."""

import struct

import numpy as np
import pyarrow as pa
import pytest

from chronopix.sources import containers
from chronopix.sources.containers import Container, container_of


def opened(data):
    return Container(pa.BufferReader(data))


@pytest.mark.parametrize("chunk", [None, (7,), (3, 2), (2, 1, 4)])
def test_arrays_come_back(chunk):
    """Of all kinds and shapes, whole and in ranges along every axis."""
    rng = np.random.default_rng(1)
    arrays = {f"g{i % 3}/deep/{kind}{shape}": (rng.random(shape) * 100).astype(kind) for i, (kind, shape) in enumerate((k, s) for k in ("<f8", "<f4", "<u1", "<i2", ">i4", "<u8") for s in ((20,), (1,), (5, 4), (3, 2, 9), (6, 1)))}
    arrays |= {"names": np.array([b"a", b"long name"]), "top": np.arange(3)}
    c = opened(container_of(arrays, chunk))
    assert set(c.datasets) == set(arrays)
    for path, x in arrays.items():
        d = c.datasets[path]
        assert d.shape == x.shape and np.array_equal(c.part(d, 0, x.shape[0]), x)
        for axis in range(x.ndim):
            n = x.shape[axis]
            for start, stop in ((0, 1), (n // 2, n), (n // 3, n + 5), (n, n + 1)):
                assert np.array_equal(c.part(d, start, stop, axis), np.take(x, range(start, min(stop, n)), axis))


def test_many_names_and_empty_arrays():
    arrays = {f"group/{'x' * (i % 11)}{i}": np.arange(i) for i in range(200)}
    c = opened(container_of(arrays))
    assert all(np.array_equal(c.part(c.datasets[p], 0, len(x)), x) for p, x in arrays.items())
    assert c.find("xxx3") is c.datasets["group/xxx3"] and c.find("nothing") is None


def test_headers_that_go_on_elsewhere():
    """An object's messages may be spread over blocks, in a chain."""
    one = struct.pack("<HHB3x", 0x10, 16, 0) + struct.pack("<QQ", 100, 40)
    two = struct.pack("<HHB3x", 1, 8, 0) + b"A" * 8 + struct.pack("<HHB3x", 0x10, 16, 0) + struct.pack("<QQ", 200, 16)
    three = struct.pack("<HHB3x", 3, 8, 0) + b"B" * 8
    data = bytearray(300)
    data[0:40] = struct.pack("<BBHII4x", 1, 0, 4, 1, len(one)) + one
    data[100 : 100 + len(two)], data[200 : 200 + len(three)] = two, three
    c = Container.__new__(Container)
    c.f = pa.BufferReader(bytes(data))
    assert list(c.messages(0)) == [(1, b"A" * 8), (3, b"B" * 8)]


def test_lists_of_filters():
    """In both formats, with names and values of any number."""
    first = struct.pack("<BB6x", 1, 3) + struct.pack("<HHHH", 2, 8, 0, 1) + b"shuffle\0" + struct.pack("<I4x", 8) + struct.pack("<HHHH", 1, 0, 0, 2) + struct.pack("<II", 6, 0) + struct.pack("<HHHH", 3, 0, 0, 0)
    second = struct.pack("<BB", 2, 2) + struct.pack("<HHH", 2, 0, 1) + struct.pack("<I", 8) + struct.pack("<HHH", 1, 0, 1) + struct.pack("<I", 6)
    assert Container.filter_ids(first) == [2, 1, 3] and Container.filter_ids(second) == [2, 1]


def test_other_files_are_errors(spark, tmp_path):
    (tmp_path / "a.h5").write_bytes(b"\x89HDF\r\n\x1a\n" + bytes([2]) + bytes(100))
    with pytest.raises(Exception, match="first format"):
        containers.sync_lines(spark, str(tmp_path), ["x"]).collect()
    with pytest.raises(Exception, match="no such file"):
        containers.sync_lines(spark, str(tmp_path / "nowhere"), ["x"]).collect()


@pytest.mark.parametrize("ticks", [1, 33, 10**6])
def test_lines_in_ranges(spark, tmp_path, ticks):
    rng = np.random.default_rng(2)
    files = {}
    for name, chunk in (("x/one", None), ("two", (10,)), ("x/three", (64, 1))):
        n = int(rng.integers(50, 90))
        on, count = rng.integers(0, 2, n).astype("u1"), rng.integers(-5, 99, n).astype("<i4").reshape(n, 1)
        files[f"{name}.h5"] = (on, count[:, 0], rng.random(n) if name != "two" else None)
        (tmp_path / name).parent.mkdir(exist_ok=True)
        lines = {"DI/Capture On": on, "CI/Frame Counter": count} | ({"AI/pid": files[f"{name}.h5"][2]} if name != "two" else {})
        (tmp_path / f"{name}.h5").write_bytes(container_of(lines, chunk))
    got = containers.sync_lines(spark, str(tmp_path), ["Capture On", "CI/Frame Counter"], ["pid"], ticks=ticks)
    rows = {(r.file, r.tick): r for r in got.collect()}
    assert set(rows) == {(f, i) for f, (on, *_) in files.items() for i in range(len(on))}
    for (f, i), r in rows.items():
        on, count, pid = files[f]
        assert (r["Capture On"], r["CI/Frame Counter"]) == (on[i], count[i]) and (r.pid is None if pid is None else r.pid == pid[i])


def test_lines_that_are_missing_or_differ(spark, tmp_path):
    (tmp_path / "a.h5").write_bytes(container_of({"a": np.arange(5), "g/b": np.arange(4)}))
    with pytest.raises(Exception, match="no line c"):
        containers.sync_lines(spark, str(tmp_path), ["a", "c"]).collect()
    with pytest.raises(Exception, match="different lengths"):
        containers.sync_lines(spark, str(tmp_path), ["a", "b"]).collect()


def test_ticks_while_recording(spark):
    rows = [("f", i, float(i > 2), float(i - 5)) for i in range(10)] + [("g", i, 1.0, 0.0) for i in range(3)] + [("h", 0, 0.0, 5.0)]
    got = containers.clipped(spark.createDataFrame(rows, "file string, tick long, on double, counter double"), "on", "counter", 10.0).collect()
    assert sorted((r.file, r.tick, round(r.time, 6)) for r in got) == [("f", i, round((i - 4) / 10, 6)) for i in range(4, 10)] + [("g", i, i / 10) for i in range(3)]


@pytest.mark.parametrize("chunk", [None, (1, 1, 2, 7)])
def test_tracks(spark, tmp_path, chunk):
    x = np.random.default_rng(3).random((2, 2, 3, 40))
    x[1, :, 2, 10:20] = np.nan
    (tmp_path / "t.h5").write_bytes(container_of({"tracks": x, "node_names": np.array([b"neck", b"tail", b"claw"])}, chunk))
    rows = containers.tracks(spark, str(tmp_path), ticks=9).collect()
    assert len(rows) == 2 * 3 * 40
    for r in rows:
        want = x[r.track, :, ["neck", "tail", "claw"].index(r.node), r.frame]
        assert (r.x, r.y) == ((None, None) if np.isnan(want[0]) else tuple(want))


def test_many_small_files_are_few_tasks(spark, tmp_path):
    """Each was a task of its own, planned one after the other before any ran."""
    for i in range(40):
        (tmp_path / f"t{i}").mkdir()
        (tmp_path / f"t{i}/t.h5").write_bytes(container_of({"tracks": np.full((1, 2, 1, 3), float(i)), "node_names": np.array([b"neck"])}))
    got = containers.tracks(spark, str(tmp_path))
    assert got.rdd.getNumPartitions() < 5
    assert sorted((r.file, r.x) for r in got.where("frame = 2").collect()) == sorted((f"t{i}/t.h5", float(i)) for i in range(40))


def test_lines_of_many_small_files_are_few_tasks(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"{i}.h5").write_bytes(container_of({"a": np.full(3, i)}))
    got = containers.sync_lines(spark, str(tmp_path), ["a"], ["b"])
    assert got.rdd.getNumPartitions() < 5
    assert sorted((r.file, r.tick, r.a, r.b) for r in got.collect()) == sorted((f"{i}.h5", t, float(i), None) for i in range(40) for t in range(3))


def test_files_are_read_once_for_their_ticks(spark, tmp_path):
    """The first tick of each file was looked for in a reading of its own, joined to another one."""
    for i in range(6):
        (tmp_path / f"{i}.h5").write_bytes(container_of({"on": (np.arange(9) > i).astype("u1"), "n": np.arange(9) - 2}))
    got = containers.clipped(containers.sync_lines(spark, str(tmp_path), ["on", "n"]), "on", "n", 1.0)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") <= 2  # ranges, and what they hold
    first = [max(i + 1, 2) - 1 for i in range(6)]
    assert sorted((r.file, r.tick, r.time) for r in got.collect()) == [(f"{i}.h5", t, float(t - first[i])) for i in range(6) for t in range(first[i], 9)]


def test_small_files_are_fetched_at_once(tmp_path):
    (tmp_path / "a.h5").write_bytes(data := container_of({"g/a": np.arange(5)}))
    reads = []

    class Counted(containers.LineReader):
        def opened(self, part):
            with super().opened(part) as f:
                reads.append(type(f))
                return containers.closing(pa.BufferReader(f.read()))

    part = containers.ByteRange(str(tmp_path / "a.h5"), "a.h5", len(data), 0, 5)
    (batch,) = Counted({"path": str(tmp_path), "lines": ["a"], "optional": []}).read(part)
    assert batch.column("a").to_pylist() == [0, 1, 2, 3, 4] and reads == [pa.BufferReader]
