"""Numbers from HDF5 containers: lines on one tick clock, and tracks of keypoints.

A container's index (its groups, the shapes of its datasets and the places of their chunks) is
read by ranges of bytes, as are the chunks that a task needs: a dataset is planned as ranges of
ticks, each a task's, and no file is read whole. Read are containers of the first format
(symbol tables, first object headers, contiguous or chunked data, deflated and shuffled), which is
what recording programs write by default; another one is an error that says so."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from contextlib import closing
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopix.sources.stores import ByteRange, RangeReader, read_files

# fixed values: how a container and the parts of its index begin, and kinds of messages and filters
SIGNATURE = b"\x89HDF\r\n\x1a\n"
SPACE, KIND, LAYOUT, FILTERS, CONTINUATION, GROUP = 0x01, 0x03, 0x08, 0x0B, 0x10, 0x11
DEFLATE, SHUFFLE, CHECKSUM = 1, 2, 3
NOWHERE = (1 << 64) - 1

#: Ticks of a task, unless a reader is told otherwise, and of a batch; bytes of a file that is one task's.
TICKS, BATCH, SMALL = 1 << 22, 1 << 17, 1 << 20


@dataclass
class Dataset:
    shape: tuple[int, ...] = ()
    kind: str = ""
    at: int | None = None
    chunk: tuple[int, ...] | None = None
    index: int | None = None
    inline: bytes | None = None
    filters: list[int] = field(default_factory=list)


class Container:
    """The datasets of an open file by their paths."""

    def __init__(self, f: pa.NativeFile):
        self.f = f
        head = f.read_at(96, 0)
        if head[:8] != SIGNATURE or head[8] > 1 or head[13] != 8 or head[14] != 8:
            raise ValueError("not an HDF5 container of the first format with 64-bit places")
        root = 24 + (4 if head[8] == 1 else 0) + 32
        self.datasets: dict[str, Dataset] = {}
        self.walk("", struct.unpack_from("<Q", head, root + 8)[0])

    def messages(self, at: int) -> Iterator[tuple[int, bytes]]:
        """Kinds and contents of an object's header, with the blocks it goes on in."""
        version, _, n, _, size = struct.unpack("<BBHII", self.f.read_at(12, at))
        if version != 1:
            raise ValueError("an object's header is of a later format")
        blocks = [(at + 16, size)]
        while blocks and n:
            start, length = blocks.pop(0)
            data, i = self.f.read_at(length, start), 0
            while i + 8 <= len(data) and n:
                kind, size = struct.unpack_from("<HH", data, i)
                body, i, n = data[i + 8 : i + 8 + size], i + 8 + size, n - 1
                if kind == CONTINUATION:
                    blocks.append(struct.unpack_from("<QQ", body))
                else:
                    yield kind, body

    def walk(self, path: str, at: int) -> None:
        own = dict(self.messages(at))
        if GROUP in own:
            tree, heap = struct.unpack_from("<QQ", own[GROUP])
            size, _, place = struct.unpack("<QQQ", self.f.read_at(24, heap + 8))
            names = self.f.read_at(size, place)
            for _, node in self.entries(tree, 8):
                n = struct.unpack("<H", self.f.read_at(2, node + 6))[0]
                table = self.f.read_at(40 * n, node + 8)
                for i in range(n):
                    name, header = struct.unpack_from("<QQ", table, 40 * i)
                    self.walk(f"{path}/{names[name : names.index(0, name)].decode()}", header)
        elif LAYOUT in own and SPACE in own and KIND in own:
            self.datasets[path.strip("/")] = self.dataset(own)

    def entries(self, at: int, key: int) -> Iterator[tuple[bytes, int]]:
        """Keys and places of the lowest nodes of a tree."""
        if at == NOWHERE:
            return
        _, level, n = struct.unpack("<BBH", self.f.read_at(4, at + 4))
        data = self.f.read_at(n * (key + 8), at + 24)
        for i in range(n):
            own, child = data[i * (key + 8) : i * (key + 8) + key], struct.unpack_from("<Q", data, i * (key + 8) + key)[0]
            if level:
                yield from self.entries(child, key)
            else:
                yield own, child

    def dataset(self, own: dict[int, bytes]) -> Dataset:
        space, kind, layout = own[SPACE], own[KIND], own[LAYOUT]
        out = Dataset(struct.unpack_from(f"<{space[1]}Q", space, 8 if space[0] == 1 else 4))
        family, order, size = kind[0] & 15, ">" if kind[1] & 1 else "<", struct.unpack_from("<I", kind, 4)[0]
        if family == 3:
            out.kind = f"S{size}"
        elif family in (0, 1):
            out.kind = f"{order}{'f' if family else 'i' if kind[1] & 8 else 'u'}{size}"
        else:
            raise ValueError("only numbers and strings of fixed length are read")
        if layout[0] != 3:
            raise ValueError("a dataset's layout is of another format")
        if layout[1] == 0:
            out.inline = layout[4 : 4 + struct.unpack_from("<H", layout, 2)[0]]
        elif layout[1] == 1:
            out.at = struct.unpack_from("<Q", layout, 2)[0]
        else:
            rank = layout[2] - 1
            out.index, out.chunk = struct.unpack_from("<Q", layout, 3)[0], struct.unpack_from(f"<{rank}I", layout, 11)
        if FILTERS in own:
            out.filters = self.filter_ids(own[FILTERS])
        return out

    @staticmethod
    def filter_ids(data: bytes) -> list[int]:
        ids, i = [], 8 if data[0] == 1 else 2
        for _ in range(data[1]):
            number = struct.unpack_from("<H", data, i)[0]
            named = data[0] == 1 or number >= 256
            name = struct.unpack_from("<H", data, i + 2)[0] if named else 0
            values = struct.unpack_from("<H", data, i + (6 if named else 4))[0]
            i += (8 if named else 6) + (-(-name // 8) * 8 if data[0] == 1 else name) + 4 * values + (4 if data[0] == 1 and values % 2 else 0)
            ids.append(number)
        return ids

    def find(self, name: str) -> Dataset | None:
        """By its whole path, else by the last part of it in any group."""
        return self.datasets.get(name) or next((d for p, d in sorted(self.datasets.items()) if p.rsplit("/", 1)[-1] == name), None)

    def part(self, d: Dataset, start: int, stop: int, axis: int = 0) -> np.ndarray:
        """Values whose place along ``axis`` is in [start, stop). Chunks that were never
        written are zeros."""
        stop = min(stop, d.shape[axis])
        shape = tuple(max(0, stop - start) if i == axis else n for i, n in enumerate(d.shape))
        kind, out = np.dtype(d.kind), np.zeros(shape, d.kind)
        if not out.size:
            return out
        if d.chunk is None:
            row = int(np.prod(d.shape[1:])) * kind.itemsize
            if d.inline is None and d.at == NOWHERE:
                return out
            first, last = (start, stop) if axis == 0 else (0, d.shape[0])
            data = d.inline[first * row : last * row] if d.inline is not None else self.f.read_at((last - first) * row, d.at + first * row)
            whole = np.frombuffer(data, kind).reshape(last - first, *d.shape[1:])
            return whole if axis == 0 else np.take(whole, range(start, stop), axis)
        rank = len(d.chunk)
        for key, place in self.entries(d.index, 16 + 8 * rank):
            size, mask = struct.unpack_from("<II", key)
            corner = struct.unpack_from(f"<{rank}Q", key, 8)
            if corner[axis] >= stop or corner[axis] + d.chunk[axis] <= start:
                continue
            block = np.frombuffer(self.unfiltered(self.f.read_at(size, place), d, mask), kind).reshape(d.chunk)
            # the part of the chunk that lies in the dataset and in the range
            low = [max(start, c) if i == axis else c for i, c in enumerate(corner)]
            high = [min(stop if i == axis else n, c + k) for i, (c, k, n) in enumerate(zip(corner, d.chunk, d.shape, strict=True))]
            there = tuple(slice(a - (start if i == axis else 0), b - (start if i == axis else 0)) for i, (a, b) in enumerate(zip(low, high, strict=True)))
            out[there] = block[tuple(slice(a - c, b - c) for a, b, c in zip(low, high, corner, strict=True))]
        return out

    @staticmethod
    def unfiltered(data: bytes, d: Dataset, mask: int) -> bytes:
        size = np.dtype(d.kind).itemsize
        for i, number in reversed(list(enumerate(d.filters))):
            if mask >> i & 1:
                continue
            if number == DEFLATE:
                data = zlib.decompress(data)
            elif number == SHUFFLE:
                data = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).tobytes()
            elif number == CHECKSUM:
                data = data[:-4]
            else:
                raise ValueError(f"filter {number} is not known")
        return data


def container_of(datasets: dict[str, np.ndarray], chunk: tuple[int, ...] | None = None) -> bytes:
    """A container of the first format with arrays of numbers or of bytes by their paths, in
    chunks that are shuffled and deflated where ``chunk`` tells their shape."""
    out = bytearray(96)

    def put(data: bytes) -> int:
        out.extend(b"\0" * (-len(out) % 8))
        at = len(out)
        out.extend(data)
        return at

    def header(messages: list[tuple[int, bytes]]) -> int:
        body = b"".join(struct.pack("<HHB3x", kind, len(data) + -len(data) % 8, 0) + data + b"\0" * (-len(data) % 8) for kind, data in messages)
        return put(struct.pack("<BBHII4x", 1, 0, len(messages), 1, len(body)) + body)

    def tree(kind: int, keys: list[bytes], places: list[int]) -> int:
        return put(b"TREE" + struct.pack("<BBHQQ", kind, 0, len(places), NOWHERE, NOWHERE) + b"".join(k + struct.pack("<Q", p) for k, p in zip(keys, places, strict=False)) + keys[-1])

    def kind_of(d: np.dtype) -> bytes:
        if d.kind == "S":
            return struct.pack("<BBBBI", 0x13, 0, 0, 0, d.itemsize)
        if d.kind == "f":
            low, high, bias = (52, 11, 1023) if d.itemsize == 8 else (23, 8, 127)
            return struct.pack("<BBBBIHHBBBBI", 0x11, 0x20, 8 * d.itemsize - 1, 0, d.itemsize, 0, 8 * d.itemsize, low, high, 0, low, bias)
        return struct.pack("<BBBBIHH", 0x10, 8 if d.kind == "i" else 0, 0, 0, d.itemsize, 0, 8 * d.itemsize)

    def dataset(x: np.ndarray) -> int:
        x = np.ascontiguousarray(x, x.dtype.newbyteorder("<"))
        about = [(SPACE, struct.pack(f"<BBB5x{x.ndim}Q", 1, x.ndim, 0, *x.shape)), (KIND, kind_of(x.dtype))]
        if chunk is None or len(chunk) != x.ndim:
            return header([*about, (LAYOUT, struct.pack("<BBQQ", 3, 1, put(x.tobytes()) if x.size else NOWHERE, x.nbytes))])
        keys, places = [], []
        for corner in np.ndindex(*[-(-n // c) for n, c in zip(x.shape, chunk, strict=True)]):
            low = [i * c for i, c in zip(corner, chunk, strict=True)]
            part = x[tuple(slice(a, a + c) for a, c in zip(low, chunk, strict=True))]
            block = np.zeros(chunk, x.dtype)
            block[tuple(slice(0, n) for n in part.shape)] = part
            data = zlib.compress(np.ascontiguousarray(block.view(np.uint8).reshape(-1, x.itemsize).T).tobytes())
            keys.append(struct.pack(f"<II{x.ndim + 1}Q", len(data), 0, *low, 0))
            places.append(put(data))
        keys.append(struct.pack(f"<II{x.ndim + 1}Q", 0, 0, *x.shape, 0))
        index = tree(1, keys, places) if places else NOWHERE
        filters = struct.pack("<BB6x", 1, 2) + b"".join(struct.pack("<HHHHI4x", number, 0, 0, 1, value) for number, value in ((SHUFFLE, x.itemsize), (DEFLATE, 6)))
        return header([*about, (LAYOUT, struct.pack(f"<BBBQ{x.ndim + 1}I", 3, 2, x.ndim + 1, index, *chunk, x.itemsize)), (FILTERS, filters)])

    def group(of: dict) -> tuple[int, int]:
        heads = {n: group(v) if isinstance(v, dict) else (dataset(v), 0) for n, v in of.items()}
        names, places = bytearray(8), {}
        for n in sorted(of, key=str.encode):
            places[n] = len(names)
            names.extend(n.encode() + b"\0" * (8 - len(n.encode()) % 8))
        symbols = b"".join(struct.pack("<QQI4x16x", places[n], heads[n][0], 0) for n in places)
        leaf = put(b"SNOD" + struct.pack("<BBH", 1, 0, len(places)) + symbols)
        heap = put(b"HEAP" + struct.pack("<B3xQQQ", 0, len(names), 1, put(bytes(names))))
        last = struct.pack("<Q", max(places.values(), default=0))
        return header([(GROUP, struct.pack("<QQ", tree(0, [struct.pack("<Q", 0), last], [leaf]), heap))]), len(places)

    nested: dict = {}
    for path, x in datasets.items():
        *above, name = path.split("/")
        place = nested
        for g in above:
            place = place.setdefault(g, {})
        place[name] = x
    root, _ = group(nested)
    out[:96] = SIGNATURE + struct.pack("<BBBBBBBBHHI", 0, 0, 0, 0, 0, 8, 8, 0, 64, 16, 0) + struct.pack("<QQQQ", 0, NOWHERE, len(out), NOWHERE) + struct.pack("<QQI4x16x", 0, root, 0)
    return bytes(out)


class ContainerReader(RangeReader):
    """Reads files in ranges of ticks, for which ``start`` and ``stop`` stand here. Of large files
    tasks read the index first and make many ranges of it; a file of few bytes is one range."""

    ending = ".h5"

    def length(self, c: Container, name: str) -> int:
        raise NotImplementedError

    def opened(self, part: ByteRange) -> closing:
        """A file of few bytes is fetched at once: its index alone is dozens of small reads."""
        if part.size > SMALL:
            return super().opened(part)
        with super().opened(part) as f:
            return closing(pa.BufferReader(f.read()))

    def ranges(self, files: DataFrame) -> DataFrame:
        ticks, small = int(self.options.get("ticks", TICKS)), 0 if "ticks" in self.options else SMALL

        def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for f in batch.to_pylist():
                    n = NOWHERE >> 1
                    if f["size"] > small:
                        part = ByteRange(**f, start=0, stop=0)
                        with self.opened(part) as opened:
                            n = self.length(Container(opened), part.name)
                    starts = range(0, n, ticks) if f["size"] > small else [0]
                    for some in (starts[i : i + BATCH] for i in range(0, len(starts), BATCH)):
                        yield pa.RecordBatch.from_pylist([f | {"start": at, "stop": min(at + ticks, n) if len(starts) > 1 else n} for at in some])

        return files.select("path", "name", "size").mapInArrow(plan, "path string, name string, size long, start long, stop long")


class LineReader(ContainerReader):
    def names(self) -> tuple[list[str], list[str]]:
        return self.options["lines"], self.options["optional"]

    def length(self, c: Container, name: str) -> int:
        needed, optional = self.names()
        sizes = {}
        for n in needed + optional:
            d = c.find(n)
            if d:
                sizes[n] = d.shape[0]
            elif n in needed:
                raise KeyError(f"{name} has no line {n}")
        if len(set(sizes.values())) > 1:
            raise ValueError(f"{name}: lines of different lengths: {sizes}")
        return next(iter(sizes.values()), 0)

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        needed, optional = self.names()
        with self.opened(part) as f:
            c = Container(f)
            last = min(part.stop, self.length(c, part.name))
            for at in range(part.start, last, BATCH):
                stop = min(at + BATCH, last)
                columns = [pa.array([part.name] * (stop - at)), pa.array(np.arange(at, stop))]
                for n in needed + optional:
                    d = c.find(n)
                    columns.append(pa.nulls(stop - at, pa.float64()) if d is None else pa.array(c.part(d, at, stop).reshape(stop - at, -1)[:, 0].astype(float)))
                yield pa.RecordBatch.from_arrays(columns, ["file", "tick", *needed, *optional])


class TrackReader(ContainerReader):
    def length(self, c: Container, name: str) -> int:
        return c.find("tracks").shape[-1]

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        with self.opened(part) as f:
            c = Container(f)
            tracks, nodes = c.find("tracks"), c.find("node_names")
            names = [n.rstrip(b"\0").decode() for n in c.part(nodes, 0, nodes.shape[0]).ravel().tolist()]
            last = min(part.stop, self.length(c, part.name))
            for at in range(part.start, last, TICKS):
                x = c.part(tracks, at, min(at + TICKS, last), axis=3).astype(float)  # track, axis, node, frame
                if x.shape[1] != 2 or x.shape[2] != len(names):
                    raise ValueError(f"{part.name}: tracks of {x.shape} for {len(names)} nodes")
                animals, _, count, frames = x.shape
                points = x.transpose(0, 2, 3, 1).reshape(-1, 2)
                columns = [pa.array([part.name] * len(points)), pa.array(np.repeat(np.arange(animals, dtype=np.int32), count * frames)), pa.array([n for n in names for _ in range(frames)] * animals), pa.array(np.tile(np.arange(at, at + frames), animals * count))]
                both = [pa.array(v, mask=np.isnan(v)) for v in (points[:, 0], points[:, 1])]
                whole = pa.RecordBatch.from_arrays([*columns, *both], ["file", "track", "node", "frame", "x", "y"])
                yield from (whole[i : i + BATCH] for i in range(0, len(points), BATCH))


def sync_lines(spark: SparkSession, path: str, lines: list[str], optional: list[str] = (), **options: int) -> DataFrame:
    """file, tick and a column for each line, of all ``.h5`` files below ``path``. A line in
    ``optional`` that a file lacks is null there; one in ``lines`` that is missing is an error.
    A line goes by its path, or by its last part in any group."""
    schema = ", ".join(["file string", "tick long", *[f"`{n}` double" for n in [*lines, *optional]]])
    return read_files(spark, LineReader(options | {"path": path, "lines": list(lines), "optional": list(optional)}), schema)


def tracks(spark: SparkSession, path: str, **options: int) -> DataFrame:
    """file, track, node, frame, x and y of all ``.h5`` files below ``path``."""
    return read_files(spark, TrackReader(options | {"path": path}), "file string, track int, node string, frame long, x double, y double")


def clipped(lines: DataFrame, on: str, counter: str, rate: float) -> DataFrame:
    """The ticks of each file while ``on`` holds and ``counter`` isn't negative, and the one
    before them, with ``time`` in seconds from the first."""
    from pyspark.sql import Window

    own = Window.partitionBy("file").orderBy("tick")
    inside = (F.col(on) > 0) & (F.col(counter) >= 0)
    # in the window that numbers the ticks, so that files are read and sorted once
    first = F.min(F.when(inside, F.col("tick"))).over(own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    kept = lines.withColumn("_first", first).where(inside | (F.col("tick") == F.col("_first") - 1)).drop("_first")
    return kept.withColumn("time", (F.row_number().over(own) - 1) / rate)
