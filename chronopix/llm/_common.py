"""Helpers that the corpus operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from chronopix.session import ship_code

#: Word separators of every operator here: space, tab, \n, \v, \f, \r.
SPACE = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """A column by its name, which may hold dots, blanks or back-ticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def documents(docs: DataFrame) -> DataFrame:
    """Only the two columns that operators read, so that others can't clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(-1))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it. Only a local
    session, which has no other machine, gets one of its own where none is named."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return sc.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage through the cluster's shared checkpoint folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, **options: str | int) -> DataFrame:
    """Like ``materialise``, as a Parquet table in the shared folder: smaller on disk, and
    of a size that the optimiser knows. ``options`` are the writer's."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}.parquet"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that nothing unwritten reads any more."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Ask the driver's JVM to collect its garbage. Spark deletes shuffle files that no
    table needs any more only when the objects behind them are collected, and a driver
    with memory to spare may not do so for long."""
    spark.sparkContext._jvm.System.gc()


#: Arrow types of the columns that ``map_texts`` may add, by their Spark names.
ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}


#: Characters of the texts that Python handles at once, beyond a single text.
AT_ONCE = 1 << 20


def small_batches(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of whole rows, of about AT_ONCE characters of text each."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    turn = np.cumsum(sizes) // AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(turn)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def map_texts(docs: DataFrame, make: Callable[[], Callable[[list[str]], dict[str, list]]], added: dict[str, str]) -> DataFrame:
    """Add columns that Python computes from ``text`` and drop ``text``; the others
    pass through untouched. ``make()`` runs once in each task."""
    ship_code(docs.sparkSession)
    plain, others = numbered(docs)
    fields = [f for f in plain.schema if f.name != "text"]
    schema = StructType([*fields, *(StructField(f"new{i}", DataType.fromDDL(t)) for i, t in enumerate(added.values()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per_batch = make()
        for batch in batches:
            for b in small_batches(batch):
                got = per_batch(b.column("text").to_pylist())
                new = [got[c] if isinstance(got[c], pa.Array) else pa.array(got[c], ARROW[t]) for c, t in added.items()]
                yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in fields), *new], names=schema.names)

    return plain.mapInArrow(run, schema).toDF(*others, *added)


def numbered(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with all columns but ``text`` under plain names, as Spark's own mapInArrow
    fails on names with dots or back-ticks; and their names, in order."""
    return docs.toDF(*[c if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)]), [c for c in docs.columns if c != "text"]


def filter_texts(docs: DataFrame, make: Callable[[], Callable[[list[str]], list[bool]]]) -> DataFrame:
    """The rows of ``docs`` whose text passes, with all columns and without a shuffle;
    a null text is tested as an empty one."""
    ship_code(docs.sparkSession)
    plain, _ = numbered(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = make()
        for batch in batches:
            for b in small_batches(batch):
                yield b.filter(pa.array(test([t or "" for t in b.column("text").to_pylist()]), pa.bool_()))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


#: Least and most bits of a table that tells which hashes occur, and the slices in which
#: it is put together. Beyond the most it says "maybe" more often, never a wrong "no".
FILTER_BITS, SLICES = (1 << 16, 1 << 28), 16


def bits_of(hashes: DataFrame) -> np.ndarray:
    """A bit for each of the hashes ``h``, 16 to 32 bits apiece up to the most."""
    bits = min(max(1 << (16 * hashes.count()).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(bits, bool)
        for batch in batches:
            table[batch.column("h").to_numpy() & (bits - 1)] = True
        slices = {i: np.packbits(p, bitorder="little").tobytes() for i, p in enumerate(np.split(table, SLICES)) if p.any()}
        yield pa.RecordBatch.from_arrays([pa.array(list(slices), pa.int32()), pa.array(list(slices.values()), pa.binary())], ["slice", "bits"])

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, part in zip(batch.column("slice").to_pylist(), batch.column("bits"), strict=True):
                one = np.frombuffer(part.as_buffer(), np.uint8)
                total[i] = total[i] | one if i in total else one
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())], ["slice", "bits"])

    marks = hashes.mapInArrow(mark, "slice int, bits binary")
    table = np.zeros((SLICES, bits // 8 // SLICES), np.uint8)
    for r in marks.repartition(SLICES, "slice").mapInArrow(unite, "slice int, bits binary").collect():
        table[r["slice"]] |= np.frombuffer(r["bits"], np.uint8)
    return table.ravel()


def has_bit(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h.astype(np.int64) & (8 * len(table) - 1)
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
