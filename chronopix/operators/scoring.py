"""Classes of feature vectors by a small model, with how sure it is."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from chronopix.session import ship_code


@dataclass
class Model:
    """Names of classes, in order, and for each a weight for every feature."""

    classes: list
    weights: np.ndarray


def class_means(df: DataFrame, vector: str, label: str) -> Model:
    """A class's weights are the means of its vectors; classes are of a bounded number, so the
    means are what comes to the driver. Null labels and vectors are left out."""
    long = df.where(F.col(label).isNotNull()).select(label, F.posexplode(vector).alias("i", "x"))
    rows = long.groupBy(label, "i").agg(F.avg("x").alias("m")).collect()
    classes = sorted({r[label] for r in rows})
    weights = np.zeros((len(classes), 1 + max((r["i"] for r in rows), default=-1)))
    for r in rows:
        weights[classes.index(r[label]), r["i"]] = r["m"]
    return Model(classes, weights)


def scored(df: DataFrame, vector: str, model: Model, *, sharpness: float = 1.0) -> DataFrame:
    """``df`` without ``vector``, with ``prediction``, ``entropy`` and ``probabilities`` of the
    classes in their order: the shares of exponentials of weighted sums. Of equal ones the
    first class is predicted; a null vector has none of the three."""
    ship_code(df.sparkSession)
    kept = [f for f in df.schema if f.name != vector]
    kind = "long" if all(isinstance(c, int) for c in model.classes) else "string"
    schema = StructType([*kept, *StructType.fromDDL(f"prediction {kind}, entropy double"), StructField("probabilities", ArrayType(DoubleType()))])
    pa_kind = to_arrow_type(schema["prediction"].dataType)
    classes, weights = model.classes, model.weights * sharpness  # as many numbers as classes and features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column(vector).to_pylist()
            some = [i for i, v in enumerate(own) if v is not None]
            out: list[tuple] = [(None, None, None)] * len(own)
            if some:
                s = np.array([own[i] for i in some], float) @ weights.T
                p = np.exp(s - s.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                entropy = -(p * np.log(np.where(p > 0, p, 1.0))).sum(1)
                for i, k, e, each in zip(some, p.round(9).argmax(1).tolist(), entropy.tolist(), p.tolist(), strict=True):
                    out[i] = (classes[k], e, each)
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 3, (pa_kind, pa.float64(), pa.list_(pa.float64())), strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in kept), *columns], names=schema.names)

    return df.select(*[f.name for f in kept], F.col(vector).cast("array<double>").alias(vector)).mapInArrow(run, schema)
