"""Files that recordings come in, and files that results go to.

All paths are opened by Spark, so they may lie in any store that it reads."""

from __future__ import annotations

import io
import re
import tempfile
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# fixed values: the columns of an optic-flow sensor's output, in the order of the file
SENSOR_COLUMNS = ["sens0X", "sens0Y", "sens1X", "sens1Y", "OpflowTime"]

# fixed values: the columns of a ball tracker's output, in the order of the file
TRACKER_COLUMNS = [
    "Frame_counter",
    "delta_rot_cam_right", "delta_rot_cam_down", "delta_rot_cam_forward", "delta_rot_error",
    "delta_rot_lab_side", "delta_rot_lab_forward", "delta_rot_lab_turn",
    "abs_rot_cam_right", "abs_rot_cam_down", "abs_rot_cam_forward",
    "abs_rot_lab_side", "abs_rot_lab_forward", "abs_rot_lab_turn",
    "integrated_lab_x", "integrated_lab_y", "integrated_lab_heading",
    "animal_movement_direction_lab", "animal_movement_speed",
    "integrated_forward_movement", "integrated_side_movement",
    "timestamp", "seq_counter", "delta_time", "alt_time",
]


def shared_scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share. Only a local session, which has no
    other machine, gets a place of its own where none is named."""
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{base or tempfile.mkdtemp(prefix='shared-')}/{uuid.uuid4().hex}"


def sensor_csv(spark: SparkSession, path: str) -> DataFrame:
    """Optic-flow sensors: five numbers a line, without a header."""
    return spark.read.schema(", ".join(f"{c} double" for c in SENSOR_COLUMNS)).csv(path)


def tracker_csv(spark: SparkSession, path: str) -> DataFrame:
    """A ball tracker's output: 25 numbers a line, without a header. Of several recordings
    (folders of part files) under ``path`` the one that was written last is read."""
    rows = spark.read.schema(", ".join(f"{c} double" for c in TRACKER_COLUMNS)).option("recursiveFileLookup", "true").csv(path)
    recording = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
    of_files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.regexp_replace("path", "/[^/]*$", "").alias("recording"), "modificationTime")
    last = of_files.agg(F.max(F.struct("modificationTime", "recording")).alias("last")).select("last.recording")
    # one row: the size of the broadcast is known
    return rows.withColumn("recording", F.regexp_replace(recording, "^file:/+", "file:/")).join(F.broadcast(last.select(F.regexp_replace("recording", "^file:/+", "file:/").alias("recording"))), "recording").drop("recording")


def camera_metadata(spark: SparkSession, path: str) -> DataFrame:
    """camera, frame, grabbed, fps, height, width from a JSON document for each recording."""
    schema = "trial string, FPS double, `Frame Counts` map<string,map<string,bigint>>, ROI struct<Height:map<string,int>,Width:map<string,int>>"
    docs = spark.read.schema(schema).json(path)
    cameras = docs.select("trial", F.col("FPS").alias("fps"), "ROI", F.explode("Frame Counts").alias("camera", "counts"))
    frames = cameras.select("trial", "camera", "fps", F.element_at("ROI.Height", F.col("camera")).alias("height"), F.element_at("ROI.Width", F.col("camera")).alias("width"), F.explode("counts").alias("frame", "grabbed"))
    return frames.withColumn("frame", F.col("frame").cast("long"))


def manifest(spark: SparkSession, path: str, remove_empty: bool = True) -> DataFrame:
    """Lines of a text file, without blanks around them."""
    lines = spark.read.text(path).select(F.trim("value").alias("line"))
    return lines.where(F.col("line") != "") if remove_empty else lines


def write_centres(centres: DataFrame, path: str) -> None:
    """``idx: y, x`` in fields of three digits, one line for each centre."""
    centres.select(F.format_string("%3d: %3d, %3d", F.col("idx").cast("int"), F.col("y").cast("int"), F.col("x").cast("int")).alias("value")).write.text(path)


def read_centres(spark: SparkSession, path: str, distinct: bool = True) -> DataFrame:
    """idx, y, x from the last characters of each line; with ``distinct`` only the first
    index of each place."""
    line = F.col("line")
    field = lambda start, n: F.trim(F.substring(line, start, n)).cast("int")
    got = manifest(spark, path).select(F.trim(F.regexp_extract("line", r"^\s*(\d+)\s*:", 1)).cast("int").alias("idx"), field(-8, 3).alias("y"), field(-3, 3).alias("x"))
    return got.groupBy("y", "x").agg(F.min("idx").alias("idx")).select("idx", "y", "x") if distinct else got


# fixed values: characters that a folder of a table stands for by their codes, and its name for null
RESERVED = "%" + "".join(map(chr, range(1, 32))) + "\"#'*/:=?\\\x7f{[]^"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def write_labels(labels: DataFrame, path: str, trial: str = "trial_id") -> None:
    """One folder of CSV for each trial, with a header; tasks write, and move, many trials each."""
    from chronopix.operators.groups import changes
    from chronopix.session import ship_code
    from chronopix.sources.stores import located, write_files

    spark = labels.sparkSession
    ship_code(spark)
    store, place = located(path)
    if store.get_file_info(place).type.name != "NotFound":
        raise FileExistsError(f"{path} is there already")
    store.create_dir(place, recursive=True)
    others = [c for c in labels.columns if c != trial]
    plain = F.col(trial).cast("string")
    coded = reduce(lambda v, c: F.replace(v, F.lit(c), F.lit(f"%{ord(c):02X}")), RESERVED, plain)
    any_reserved = "[" + "".join(f"\\x{ord(c):02x}" for c in RESERVED) + "]"
    value = F.when(plain == "", NO_VALUE).when(plain.rlike(any_reserved), coded).otherwise(F.coalesce(plain, F.lit(NO_VALUE)))
    rows = labels.select(F.concat(F.lit(f"{trial}="), value, F.lit("/labels.csv")).alias("file"), F.to_csv(F.struct(*others)).alias("line"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(others)])
    sorted_rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file").sortWithinPartitions("file", *rows.columns[2:]).select("file", "line")
    header = ",".join(others) + "\n"

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            lines, names, contents = batch.column("line").to_pylist(), [], []
            bounds = [0, *changes(batch, ["file"]), batch.num_rows] if lines else [0]
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                names.append(batch.column("file")[int(a)].as_py())
                contents.append(("" if names[-1] == last else header) + "\n".join(lines[a:b]) + "\n")
                last = names[-1]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([0] * len(names), pa.int64()), pa.array([c.encode() for c in contents], pa.binary())], ["file", "part", "content"])

    write_files(sorted_rows.mapInArrow(united, "file string, part long, content binary"), path, dealt=True)


def read_labels(spark: SparkSession, path: str, columns: str, trial: str = "trial_id", kind: str = "string") -> DataFrame:
    """``trial``, from the folders' names, and ``columns`` of what ``write_labels`` wrote. A task
    reads many small files, or a part of a large one."""
    from chronopix.sources.stores import ByteRange, RangeReader, read_files

    class LineReader(RangeReader):
        ending = ".csv"

        def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
            value = next((v for k, _, v in (x.partition("=") for x in part.name.split("/")) if k == trial), NO_VALUE)
            of = None if value == NO_VALUE else re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), value)
            with self.opened(part) as opened, io.BufferedReader(opened, 1 << 20) as f:
                # a line belongs to the range that it begins in; the first one of a file is the header
                at = max(0, part.start - 1)
                f.seek(at)
                at += len(f.readline())
                while at < part.stop:
                    lines: list[str] = []
                    while at < part.stop and len(lines) < 1 << 14:
                        line = f.readline()
                        at += len(line)
                        if text := line.decode(errors="replace").rstrip("\r\n"):
                            lines.append(text)
                    yield pa.RecordBatch.from_arrays([pa.array([of] * len(lines), pa.string()), pa.array(lines, pa.string())], ["trial", "line"])

    lines = read_files(spark, LineReader({"path": path}), "trial string, line string")
    return lines.select(F.col("trial").cast(kind).alias(trial), F.from_csv("line", columns).alias("_of")).select(trial, "_of.*")


def raw_frames(spark: SparkSession, path: str, width: int, height: int, channels: int = 1, planes: int = 1, kept_planes: int | None = None) -> DataFrame:
    """frame, channel, plane and values (row by row) of a raw file of unsigned 16-bit
    numbers. A time step holds all planes, a plane its rows, and a pixel its channels side
    by side; planes from ``kept_planes`` on are fly-back and are dropped. A file of any size
    is read by many tasks."""
    from chronopix.sources.stacks import raw_recordings

    got = raw_recordings(spark, path, width=width, height=height, channels=channels, planes=planes, kept_planes=planes if kept_planes is None else kept_planes, order="pixels")
    return got.select("frame", "channel", "plane", "values")


def discovered(paths: DataFrame, path: str, parent: str, *, startswith: str = "", endswith: str = "", contains: str = "", exclude: str | None = None) -> DataFrame:
    """Names that pass all predicates, numbered within their parent in their order."""
    name = F.col(path)
    kept = paths.where(name.startswith(startswith) & name.endswith(endswith) & name.contains(contains))
    if exclude:
        kept = kept.where(~name.contains(exclude))
    return kept.withColumn("position", F.row_number().over(Window.partitionBy(parent).orderBy(path)) - 1)


def unique_match(names: DataFrame, name: Column, keys: list[str]) -> DataFrame:
    """For each key whether exactly one name is there: found, ambiguous (and which first)."""
    return names.groupBy(*keys).agg(F.min(name).alias("match"), F.when(F.count("*") == 1, "found").otherwise("ambiguous").alias("state"))


def frame_gaps(names: DataFrame, name: Column, keys: list[str]) -> DataFrame:
    """Frame numbers from image names: how many, the first, the last, and the gaps."""
    number = F.regexp_extract(name, r"_img_(\d+)\.jpg$", 1).cast("long")
    order = Window.partitionBy(*keys).orderBy("_n")
    steps = names.withColumn("_n", number).withColumn("_step", F.col("_n") - F.lag("_n").over(order))
    return steps.groupBy(*keys).agg(F.count("*").alias("n"), F.min("_n").alias("first"), F.max("_n").alias("last"), F.count_if(F.col("_step") != 1).alias("gaps"))
