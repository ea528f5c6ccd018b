"""Stacks of images in the files of a microscope and of image programs.

Both readers are planned by ranges of bytes and read time steps, or pages, that begin in their
range. Values come row by row as one array for each image."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from xml.etree import ElementTree

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chronopix.session import ship_code
from chronopix.sources.sinks import write_missing
from chronopix.sources.stores import ByteRange, RangeReader, read_files, write_files

#: Bytes of images that are handed to Spark at once, beyond a single one.
AT_ONCE = 8 << 20


def names_in(ddl: str) -> list[str]:
    """Columns of a flat schema."""
    return [f.split()[0] for f in ddl.split(", ")]


def batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], size: int) -> Iterator[pa.RecordBatch]:
    some: list[tuple] = []
    for r in rows:
        some.append(r)
        if len(some) * size >= AT_ONCE:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], names)
            some = []
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], names)


# raw files


def layout_of(xml: bytes) -> dict:
    """Sizes, and the colour of each channel, from a microscope's metadata. A channel whose
    tube has no gain was not recorded; fly-back planes are read and dropped."""
    root = ElementTree.fromstring(xml)
    value = lambda tag, name, default="0": (e.attrib if (e := root.find(f".//{tag}")) is not None else {}).get(name, default)
    kept = max(1, int(value("ZStage", "steps", "1")))
    gains = float(value("PMT", "gainA", "1")), float(value("PMT", "gainB", "1"))
    colours = ["green"] if gains[1] == 0 else ["red"] if gains[0] == 0 else ["green", "red"]
    channels = len(root.findall(".//Wavelength")) or len(colours)
    return {"width": int(value("LSM", "pixelX")), "height": int(value("LSM", "pixelY")), "channels": channels, "planes": kept + int(value("Streaming", "flybackFrames")) * (kept > 1), "kept_planes": kept, "colours": colours[:channels]}


class RawReader(RangeReader):
    """Raw files of unsigned 16-bit numbers: time steps of planes of channels."""

    ending = ".raw"
    DDL = "file string, frame long, channel int, colour string, plane int, height int, width int, values array<int>"
    fields = ("width", "height", "channels", "planes", "kept_planes")

    def layout(self, part: ByteRange) -> dict:
        """From the metadata beside the file where ``metadata`` names it, else from options."""
        if name := self.options.get("metadata"):
            with self.opened(ByteRange(f"{part.path.rsplit('/', 1)[0]}/{name}", name, 0, 0, 0)) as f:
                return layout_of(f.read())
        given = {k: int(self.options.get(k, 1)) for k in self.fields}
        given["kept_planes"] = int(self.options.get("kept_planes", given["planes"]))
        return given | {"colours": [None] * given["channels"]}

    def steps(self, part: ByteRange) -> Iterator[tuple]:
        of = self.layout(part)
        size = 2 * of["width"] * of["height"] * of["channels"] * of["planes"]
        side_by_side, bare = self.options.get("order", "images") == "pixels", self.options.get("values", "yes") == "no"
        with self.opened(part) as f:
            # a time step belongs to the range that it begins in; an unfinished one at the end is left out
            for step in range(-(-part.start // size), min(-(-part.stop // size), part.size // size)):
                values = np.zeros(size // 2, "<u2") if bare else np.frombuffer(f.read_at(size, step * size), "<u2")
                images = values.reshape(of["planes"], -1, of["channels"]).transpose(0, 2, 1) if side_by_side else values.reshape(of["planes"], of["channels"], -1)
                for c, colour in enumerate(of["colours"]):
                    for p in range(of["kept_planes"]):
                        yield part.name, step, c, colour, p, of["height"], of["width"], None if bare else images[p, c].astype(np.int32)

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32())]
        of = self.layout(part)
        return batches(self.steps(part), names_in(self.DDL), kinds, 4 * of["width"] * of["height"])


def raw_recordings(spark: SparkSession, path: str, **options: str | int) -> DataFrame:
    """Frames of all ``.raw`` files below ``path``. ``metadata`` names the file beside each
    that tells its sizes and channels; else width, height, channels, planes and kept_planes are
    given. An image's channels follow each other, or with ``order`` "pixels" a pixel's. With
    ``values`` "no" the images are null, and only the files' sizes are looked at."""
    return read_files(spark, RawReader(options | {"path": path}), RawReader.DDL)


def latest_step(spark: SparkSession, path: str, **options: str | int) -> DataFrame:
    """Of each recording the last whole time step, while it is still being written."""
    got = raw_recordings(spark, path, **options)
    last = got.groupBy("file").agg(F.max("frame").alias("frame"))
    return got.join(last, ["file", "frame"])


def packed(df: DataFrame, values: str, kind: str = "<u2") -> DataFrame:
    """The arrays ``values`` as bytes, under ``content``."""
    ship_code(df.sparkSession)
    others = [f for f in df.schema if f.name != values]
    schema = StructType([*others, *StructType.fromDDL("content binary")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            content = [np.asarray(v.values).astype(kind).tobytes() for v in b.column(values)]
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in others), pa.array(content, pa.binary())], names=schema.names)

    return df.mapInArrow(run, schema)


# files of pages

# fixed values: tags of an image file directory, and the kinds of its numbers
WIDTH, HEIGHT, BITS, COMPRESSION, MEANING, DESCRIPTION, STRIPS, SAMPLES, ROWS, COUNTS, FORMAT = 256, 257, 258, 259, 262, 270, 273, 277, 278, 279, 339
KINDS = {1: "B", 2: "s", 3: "H", 4: "I", 16: "Q"}
FORMATS = {1: "u", 2: "i", 3: "f"}


def page_of(values: np.ndarray, height: int, width: int, frame: int, at: int, last: bool) -> bytes:
    """A page at byte ``at`` of a file: its directory, its description, which tells the frame's
    number, and its values as one strip. Pages of one shape are equally long, so each can be made
    without those before it."""
    data, note = values.tobytes(), f"frame={frame:020d}".encode() + b"\0"
    size, data = len(data), data + b"\0" * (len(data) % 2)  # directories begin at even places
    kind = {"u": 1, "i": 2, "f": 3}[values.dtype.kind]
    body = at + 2 + 12 * 11 + 4
    tags = [(WIDTH, 4, 1, width), (HEIGHT, 4, 1, height), (BITS, 3, 1, 8 * values.itemsize), (COMPRESSION, 3, 1, 1), (MEANING, 3, 1, 1), (DESCRIPTION, 2, len(note), body), (STRIPS, 4, 1, body + len(note) + 1), (SAMPLES, 3, 1, 1), (ROWS, 4, 1, height), (COUNTS, 4, 1, size), (FORMAT, 3, 1, kind)]
    after = body + len(note) + 1 + len(data)
    head = struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", *t) for t in tags) + struct.pack("<I", 0 if last else after)
    return head + note + b"\0" + data


FILE_HEAD = b"II*\0" + struct.pack("<I", 8)


class PageReader(RangeReader):
    """Multi-page image files: the files in a folder are one stack."""

    ending = ".tif"
    DDL = "stack string, frame long, height int, width int, values array<double>"

    def pages(self, part: ByteRange) -> Iterator[tuple]:
        with self.opened(part) as f:
            head = f.read_at(16, 0)
            end = {b"II": "<", b"MM": ">"}[head[:2]]
            big = struct.unpack_from(f"{end}H", head, 2)[0] == 43
            at = struct.unpack_from(f"{end}Q", head, 8)[0] if big else struct.unpack_from(f"{end}I", head, 4)[0]
            number = 0
            # directories are a chain: those before the range are stepped over, without their values
            while at and at < part.stop:
                n = struct.unpack(f"{end}Q", f.read_at(8, at))[0] if big else struct.unpack(f"{end}H", f.read_at(2, at))[0]
                head_size, entry, link = (8, 20, 8) if big else (2, 12, 4)
                directory = f.read_at(n * entry + link, at + head_size)
                if at >= part.start:
                    yield self.page(f, part, directory, n, end, big, number)
                at, number = struct.unpack_from(f"{end}{'Q' if big else 'I'}", directory, n * entry)[0], number + 1

    def page(self, f: pa.NativeFile, part: ByteRange, directory: bytes, n: int, end: str, big: bool, number: int) -> tuple:
        tags, entry, room = {}, 20 if big else 12, 8 if big else 4
        for i in range(n):
            tag, kind = struct.unpack_from(f"{end}HH", directory, i * entry)
            count = struct.unpack_from(f"{end}{'Q' if big else 'I'}", directory, i * entry + 4)[0]
            if kind not in KINDS:
                continue
            code = KINDS[kind]
            size, place = count * struct.calcsize(f"={code}"), i * entry + entry - room
            raw = directory[place : place + size] if size <= room else f.read_at(size, struct.unpack_from(f"{end}{'Q' if big else 'I'}", directory, place)[0])
            tags[tag] = raw.rstrip(b"\0") if code == "s" else struct.unpack(f"{end}{count}{code}", raw)
        if tags.get(COMPRESSION, (1,))[0] != 1 or tags.get(SAMPLES, (1,))[0] != 1:
            raise ValueError(f"{part.name}: only pages of one uncompressed channel are read")
        height, width = tags[HEIGHT][0], tags[WIDTH][0]
        kind = f"{end}{FORMATS[tags.get(FORMAT, (1,))[0]]}{tags[BITS][0] // 8}"
        counts = tags.get(COUNTS, (height * width * np.dtype(kind).itemsize,))
        data = b"".join(f.read_at(c, at) for at, c in zip(tags[STRIPS], counts, strict=True))
        note = tags.get(DESCRIPTION, b"")
        frame = int(note[6:]) if note.startswith(b"frame=") and note[6:].isdigit() else number
        stack = part.name.rsplit("/", 1)[0] if "/" in part.name else part.name.removesuffix(self.ending)
        return stack, frame, height, width, np.frombuffer(data, kind).astype(float)

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.float64())]
        found = self.pages(part)
        first = next(found, None)
        if first is None:
            return iter(())
        chain = (row for rows in ([first], found) for row in rows)
        return batches(chain, names_in(self.DDL), kinds, 8 * len(first[-1]))


def read_stacks(spark: SparkSession, path: str, **options: str | int) -> DataFrame:
    """stack, frame, height, width and values of all ``.tif`` files below ``path``; a page's
    frame is what its description says, else its place in the file. A missing path is an error."""
    return read_files(spark, PageReader(options | {"path": path}), PageReader.DDL)


def write_stacks(df: DataFrame, path: str, *, kind: str = "<f8", pages: int = 1000) -> None:
    """Rows of stack (a folder's path below ``path``), frame, height, width and values, as
    files of up to ``pages`` frames each, so that a long stack is written by many tasks. All images
    of a stack are of one size; ``kind`` is the kind of numbers in the files, and values
    that it can't hold are an error. Frames are numbered from 0, with or without gaps."""
    ship_code(df.sparkSession)
    limit = np.iinfo(kind) if np.dtype(kind).kind in "ui" else None
    rows = df.select(F.col("stack").cast("string").alias("stack"), F.col("frame").cast("long").alias("frame"), F.col("height").cast("int").alias("height"), F.col("width").cast("int").alias("width"), F.col("values").cast("array<double>").alias("values"))
    lot = F.floor(F.col("frame") / pages)
    name = F.concat("stack", F.lit("/"), F.lpad(lot.cast("string"), 9, "0"), F.lit(".tif"))
    named = rows.withColumn("file", name)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by file and frame, with the next row's file beside them."""
        file, at = None, 0
        for b in batches:
            out = []
            for f, frame, h, w, values, following in zip(*(b.column(c).to_pylist() for c in ("file", "frame", "height", "width")), b.column("values"), b.column("following").to_pylist(), strict=True):
                if limit and len(values.values) and (min(values.values.to_numpy()) < limit.min or max(values.values.to_numpy()) > limit.max):
                    raise ValueError(f"{f}: values beyond {kind}")
                data = values.values.to_numpy().astype(kind)
                if len(data) != h * w:
                    raise ValueError(f"{f}: {len(data)} values in an image of {h} by {w}")
                head = b"" if f == file else FILE_HEAD
                at = at if f == file else len(FILE_HEAD)
                file = f
                page = page_of(data, h, w, frame, at, last=not following)
                at += len(page)
                out.append((f, frame, head + page))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate((pa.string(), pa.int64(), pa.binary()))], ["file", "part", "content"])

    from pyspark.sql import Window

    # the window deals rows by file and sorts them, as the sink needs them too
    following = F.lead(F.lit(True), 1, False).over(Window.partitionBy("file").orderBy("frame"))
    ready = named.withColumn("following", following).select("file", "frame", "height", "width", "values", "following")
    write_files(ready.mapInArrow(place, "file string, part long, content binary"), path, dealt=True)


def convert_recordings(spark: SparkSession, raw: str, target: str, *, overwrite: bool = False, **options: str | int) -> int:
    """Raw recordings as a table by recording and colour; those that are whole at ``target``
    are not written again. Returns how many parts were written, and reads no image if there
    are none."""
    rows = lambda df: df.select(F.regexp_replace("file", "/[^/]*$", "").alias("trial"), F.coalesce("colour", F.concat(F.lit("channel"), F.col("channel").cast("string"))).alias("colour"), "frame", "plane", "height", "width", "values")
    images, bare = (rows(raw_recordings(spark, raw, values=v, **options)) for v in ("yes", "no"))
    return write_missing(images, target, ["trial", "colour"], expected=bare, overwrite=overwrite)
