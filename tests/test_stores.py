"""Recordings' own formats: ranges of bytes, pages of images, folders, nested poses."""

import json
import os
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronopix.sources import poses, sinks, stacks, stores

XML = '<E><Wavelengths>{w}</Wavelengths><LSM pixelX="5" pixelY="4"/><ZStage steps="{z}"/><PMT gainA="{a}" gainB="{b}"/><Streaming flybackFrames="{f}"/></E>'


def below(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names if not f.endswith(".crc"))


# bytes


def test_files_from_rows(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(f"a{i % 3}/b/{i % 5}.bin", i // 15, bytes(rng.bytes(int(rng.integers(0, 50))))) for i in range(300)]
    order = rng.permutation(300)
    df = spark.createDataFrame([rows[i] for i in order], "file string, part long, content binary").repartition(7)
    path = str(tmp_path / "files")
    stores.write_files(df, path)
    names = sorted({r[0] for r in rows})
    assert below(path) == names
    for n in names:
        assert (tmp_path / "files" / n).read_bytes() == b"".join(r[2] for r in sorted(rows, key=lambda r: r[1]) if r[0] == n)
    stores.write_files(df.where("false"), str(tmp_path / "none"))


def test_tasks_move_files(spark, tmp_path, monkeypatch):
    """The driver moved them one after the other; here it can't."""
    import pyarrow.fs as fs

    path = str(tmp_path / "files")
    df = spark.range(100).select(F.concat(F.lit("a/f"), (F.col("id") % 40).cast("string")).alias("file"), F.col("id").alias("part"), F.lit("x").cast("binary").alias("content"))
    real, driver = stores.located, os.getpid()

    class Fixed:
        def __getattr__(self, name):
            if name in ("move", "create_dir") and os.getpid() == driver:
                raise AssertionError("on the driver")
            return getattr(fs.LocalFileSystem(), name)

    monkeypatch.setattr(stores, "located", lambda address: (Fixed(), real(address)[1]))
    stores.write_files(df, path)
    assert len(below(path)) == 40 and not [f for f in os.listdir(path) if f.startswith("_")]


def noted_tasks(monkeypatch, notes):
    """Tasks that write (w) or move (m) files leave notes with their numbers."""
    import pyarrow.fs as fs
    from pyspark import TaskContext

    real = stores.located

    class Noting:
        def __getattr__(self, name):
            if kind := {"open_output_stream": "w", "move": "m"}.get(name):
                os.makedirs(f"{notes}/{kind}{TaskContext.get().partitionId()}", exist_ok=True)
            return getattr(fs.LocalFileSystem(), name)

    monkeypatch.setattr(stores, "located", lambda address: (Noting(), real(address)[1]))


def test_rows_by_file_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """Rows that were by file already, as distinct ones are, were united into the one task that their few bytes fill."""
    noted_tasks(monkeypatch, str(tmp_path / "notes"))
    files = spark.range(200).select(F.concat(F.lit("f"), (F.col("id") % 100).cast("string")).alias("file")).distinct()
    stores.write_files(files.select("file", F.lit(0).alias("part"), F.lit("x").cast("binary").alias("content")), str(tmp_path / "files"))
    assert len(below(str(tmp_path / "files"))) == 100 and len([n for n in os.listdir(tmp_path / "notes") if n[0] == "w"]) == 4


def test_files_are_moved_by_tasks_of_equal_numbers(spark, tmp_path, monkeypatch):
    """They were moved in as many tasks as their names' few bytes fill."""
    noted_tasks(monkeypatch, str(tmp_path / "notes"))
    monkeypatch.setattr(stores, "FILES", 9)
    files = spark.range(100).select(F.concat(F.lit("f"), F.col("id").cast("string")).alias("file"), F.lit(0).alias("part"), F.lit("x").cast("binary").alias("content"))
    stores.write_files(files, str(tmp_path / "files"))
    assert len(below(str(tmp_path / "files"))) == 100 and len([n for n in os.listdir(tmp_path / "notes") if n[0] == "m"]) == 12


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "files")
    df = spark.range(100).select(F.concat(F.lit("f"), (F.col("id") % 4).cast("string")).alias("file"), F.col("id").alias("part"), F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise("x").cast("binary").alias("content"))
    with pytest.raises(Exception, match="broken"):
        stores.write_files(df, path)
    assert not os.path.isdir(path) or below(path) == []


@pytest.mark.parametrize("split", [1, 100, 333, 10**9])
def test_raw_files_in_ranges(spark, tmp_path, split):
    """Whatever the ranges, each whole step is read once; an unfinished one is left out."""
    rng = np.random.default_rng(2)
    stack = rng.integers(0, 65536, (6, 3, 2, 20)).astype("<u2")  # time, plane, channel, pixel
    for name, extra in (("x/one.raw", b""), ("y/two.raw", b"abc"), ("y/_new.raw", b"")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(stack.tobytes() + extra)
    size = {"width": 5, "height": 4, "channels": 2, "planes": 3, "kept_planes": 2}
    if split == 1:
        split = 60  # less than a step
    got = stacks.raw_recordings(spark, str(tmp_path), split=split, **size)
    rows = got.collect()
    assert len(rows) == 2 * 6 * 2 * 2 and {r.file for r in rows} == {"x/one.raw", "y/two.raw"}
    for r in rows:
        assert r["values"] == stack[r.frame, r.plane, r.channel].tolist() and (r.height, r.width, r.colour) == (4, 5, None)
    bare = stacks.raw_recordings(spark, str(tmp_path), split=split, values="no", **size).collect()
    key = lambda r: (r.file, r.frame, r.channel, r.plane)
    assert sorted(map(key, bare)) == sorted(map(key, rows)) and all(r["values"] is None for r in bare)
    last = stacks.latest_step(spark, str(tmp_path), split=split, **size).collect()
    assert len(last) == 8 and {r.frame for r in last} == {5}


@pytest.mark.parametrize(("w", "z", "a", "b", "f", "colours", "kept", "planes"), [(2, 1, 5, 5, 3, ["green", "red"], 1, 1), (1, 3, 5, 0, 1, ["green"], 3, 4), (1, 1, 0, 5, 0, ["red"], 1, 1), (2, 2, 5, 0, 0, ["green"], 2, 2)])
def test_metadata_tell_the_layout(spark, tmp_path, w, z, a, b, f, colours, kept, planes):
    (tmp_path / "Experiment.xml").write_text(XML.format(w="<Wavelength/>" * w, z=z, a=a, b=b, f=f))
    stack = np.arange(2 * planes * w * 20).astype("<u2").reshape(2, planes, w, 20)
    (tmp_path / "Image.raw").write_bytes(stack.tobytes())
    rows = stacks.raw_recordings(spark, str(tmp_path), metadata="Experiment.xml").collect()
    assert len(rows) == 2 * kept * len(colours)
    for r in rows:
        assert r.colour == colours[r.channel] and r["values"] == stack[r.frame, r.plane, r.channel].tolist()


def test_conversion_of_new_recordings_only(spark, tmp_path):
    """A second run does nothing; a recording that grew, and one that came, are converted."""
    raw, target = tmp_path / "raw", str(tmp_path / "target")

    def record(name, steps):
        (raw / name).mkdir(parents=True, exist_ok=True)
        (raw / name / "Experiment.xml").write_text(XML.format(w="<Wavelength/>" * 2, z=1, a=1, b=1, f=0))
        (raw / name / "Image.raw").write_bytes(np.full((steps, 2, 20), steps, "<u2").tobytes())

    def convert():
        return stacks.convert_recordings(spark, str(raw), target, metadata="Experiment.xml")

    record("t1", 3)
    record("t2", 4)
    assert (convert(), convert()) == (4, 0)
    record("t2", 6)
    record("t3", 1)
    before = {f: os.path.getmtime(f"{target}/{f}") for f in below(target) if "trial=t1" in f}
    assert (convert(), convert()) == (4, 0)
    assert before == {f: os.path.getmtime(f"{target}/{f}") for f in below(target) if "trial=t1" in f}
    got = {(r.trial, r.colour): (r.n, r.v) for r in sinks.stored(spark, target).groupBy("trial", "colour").agg(F.count("*").alias("n"), F.max(F.col("values")[0]).alias("v")).collect()}
    assert got == {(t, c): (n, n) for t, n in (("t1", 3), ("t2", 6), ("t3", 1)) for c in ("green", "red")}
    assert sinks.stored(spark, str(tmp_path / "nowhere")) is None


# pages


def stack_rows(spark, arrays):
    rows = [(name, f, *x.shape[1:], x[i].ravel().tolist()) for name, (x, frames) in arrays.items() for i, f in enumerate(frames)]
    return spark.createDataFrame(rows, "stack string, frame long, height int, width int, values array<double>").repartition(5)


@pytest.mark.parametrize("kind", ["<f8", "<f4", "<u2", "<u1", "<i2"])
def test_stacks_of_pages(spark, tmp_path, kind):
    rng = np.random.default_rng(3)
    arrays = {"a/green": (rng.integers(0, 200, (23, 3, 5)).astype(float), range(23)), "b": (rng.integers(0, 200, (4, 1, 1)).astype(float), [0, 7, 8, 30])}
    path = str(tmp_path / "stacks")
    stacks.write_stacks(stack_rows(spark, arrays), path, kind=kind, pages=10)
    assert below(path) == [f"a/green/00000000{i}.tif" for i in range(3)] + ["b/000000000.tif", "b/000000003.tif"]
    for split in (50, 1000, 10**9):
        rows = stacks.read_stacks(spark, path, split=split).collect()
        assert len(rows) == 27
        for r in rows:
            x, frames = arrays[r.stack]
            assert r["values"] == x[list(frames).index(r.frame)].ravel().tolist() and (r.height, r.width) == x.shape[1:]


def test_values_that_do_not_fit(spark, tmp_path):
    df = stack_rows(spark, {"a": (np.full((2, 2, 2), 70000.0), range(2))})
    with pytest.raises(Exception, match="beyond <u2"):
        stacks.write_stacks(df, str(tmp_path / "x"), kind="<u2")
    with pytest.raises(Exception, match="no such file"):
        stacks.read_stacks(spark, str(tmp_path / "nowhere")).collect()


def plain_pages(images, end, big, strips):
    """A file as another program may write it: values first, strips of some rows, directories
    anywhere, in either order of bytes, with 32- or 64-bit places."""
    number, room = ("Q", 8) if big else ("I", 4)
    out = bytearray(end[1] + struct.pack(f"{end[0]}H", 43 if big else 42) + (struct.pack(f"{end[0]}HHQ", 8, 0, 0) if big else struct.pack(f"{end[0]}I", 0)))
    link = 8 if big else 4
    for x in images:
        rows = [x[i : i + strips] for i in range(0, len(x), strips)]
        places, sizes = [], []
        for r in rows:
            places.append(len(out))
            out += r.astype(f"{end[0]}u2").tobytes()
            sizes.append(r.size * 2)

        def array(values, out=out):
            data = struct.pack(f"{end[0]}{len(values)}{number}", *values)
            if len(data) <= room:
                return data.ljust(room, b"\0")
            at = len(out)
            out += data
            return struct.pack(f"{end[0]}{number}", at)

        short = lambda v: struct.pack(f"{end[0]}H", v).ljust(room, b"\0")
        wide = 16 if big else 4
        tags = [(256, 3, 1, short(x.shape[1])), (257, 3, 1, short(x.shape[0])), (258, 3, 1, short(16)), (259, 3, 1, short(1)), (273, wide, len(places), array(places)), (278, 3, 1, short(strips)), (279, wide, len(sizes), array(sizes)), (305, 5, 1, b"\0" * room)]
        struct.pack_into(f"{end[0]}{number}", out, link, len(out))
        out += struct.pack(f"{end[0]}{'Q' if big else 'H'}", len(tags))
        for tag, kind, n, value in tags:
            out += struct.pack(f"{end[0]}HH{number}", tag, kind, n) + value
        link = len(out)
        out += b"\0" * room
    return bytes(out)


@pytest.mark.parametrize("end", [("<", b"II"), (">", b"MM")])
@pytest.mark.parametrize("big", [False, True])
def test_pages_of_other_programs(spark, tmp_path, end, big):
    images = np.random.default_rng(4).integers(0, 65536, (5, 7, 3))
    (tmp_path / "stack.tif").write_bytes(plain_pages(images, end, big, 2))
    for split in (64, 10**9):
        rows = stacks.read_stacks(spark, str(tmp_path / "stack.tif"), split=split).collect()
        assert sorted(r.frame for r in rows) == list(range(5))
        for r in rows:
            assert r.stack == "stack" and r["values"] == images[r.frame].ravel().tolist()


# folders and poses


def test_walk_through_folders(spark, tmp_path):
    for name in ("210301_x/Fly1/t1/a/b.txt", "210301_x/Fly1/t2_off/b.txt", "210301_x/fly2/t1/b.txt", "210301_x/fly2/processed/b.txt", "210301_x/Bee1/t1/b.txt", "210302_x/Fly1/t9/b.txt", "210302_x/Fly1/note.txt", "210302_x/Fly3/t 1#ü/b.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    files = stores.folders(spark, str(tmp_path))
    of = lambda **k: sorted((r.date[5], r.fly, r.trial, r.position) for r in stores.trials_of_flies(files, **k).collect())
    assert of() == [("1", "Fly1", "t1", 0), ("1", "Fly1", "t2_off", 1), ("1", "fly2", "t1", 0), ("2", "Fly1", "t9", 0), ("2", "Fly3", "t 1#ü", 0)]
    assert of(exclude="off", fly_endswith="1") == [("1", "Fly1", "t1", 0), ("2", "Fly1", "t9", 0)]
    assert of(startswith="t2", endswith="off", contains="_") == [("1", "Fly1", "t2_off", 0)]
    assert of(fly_contains="y2", exclude=None) == [("1", "fly2", "processed", 0), ("1", "fly2", "t1", 1)]
    assert {r.modified is not None for r in files.collect()} == {True}


def test_what_is_found_stays_with_tasks(spark, tmp_path):
    """The driver held the state of every file, as an index of input files."""
    for i in range(30):
        (tmp_path / f"f{i % 10}/_x").mkdir(parents=True, exist_ok=True)
        (tmp_path / f"f{i % 10}/{i}").write_text("x")
        (tmp_path / f"f{i % 10}/_x/{i}").write_text("x")
    files = stores.folders(spark, str(tmp_path))
    assert not any(str(tmp_path) in f for f in files.inputFiles())
    assert sorted(r.file for r in files.collect()) == sorted(f"f{i % 10}/{i}" for i in range(30))
    (tmp_path / "none").mkdir()
    assert stores.folders(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(FileNotFoundError, match="no such file"):
        stores.folders(spark, str(tmp_path / "nowhere"))


def test_poses(spark, tmp_path):
    """Trials may lack legs, joints and markers; the head has joints only."""
    at = lambda *p: {"raw_pos_aligned": [list(x) for x in p]}
    docs = [
        {"trial": "a", "angles": {"LF": {"yaw": [1, 2]}, "Head": {"roll": [9, 9]}}, "joints": {"LF": {"Coxa": at((1, 2, 3), (4, 5, 6))}, "Head": {"Eye": at((7, 8, 9), (0, 0, 0))}}, "points3d": [[[0, 0, 0], [1, 1, 2]], [[5, 5, 5], [3, 3, 4]]]},
        {"trial": "b", "angles": {"LF": {"pitch": [5]}}, "joints": {}},
        {"trial": "c", "angles": {}, "joints": {}},
    ]
    (tmp_path / "poses.json").write_text("\n".join(map(json.dumps, docs)))
    got = poses.flat_poses(poses.read_poses(spark, str(tmp_path / "poses.json")), abdomen={"RStripe1": 1})
    names = ["angle_LF_pitch", "angle_LF_yaw", *[f"joint_{j}_{a}" for j in ("Head_Eye", "LF_Coxa", "Abd_RStripe1") for a in "xyz"]]
    assert got.columns == ["trial", "frame", *names]
    rows = {(r.trial, r.frame): r for r in got.collect()}
    assert set(rows) == {("a", 0), ("a", 1), ("b", 0)}
    assert tuple(rows["a", 1])[2:] == (None, 2, 0, 0, 0, 4, 5, 6, 3, 3, 4) and tuple(rows["b", 0])[2:] == (5, *[None] * 10)
