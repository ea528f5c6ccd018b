"""Morlet wavelet amplitudes of long recordings, in pieces that overlap.

The wavelet of a frequency is a wave under a bell of REACH standard deviations to each
side. A recording is cut into pieces of ``piece`` frames with a border of the longest
wavelet's half on both sides, so that a piece has all that its frames' coefficients need:
one recording of any length is many tasks, and the cuts don't show in the result."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronopix.operators.groups import map_groups

#: Half the length of a wavelet in standard deviations of its bell, beyond which it is
#: less than 1e-10 of its height; and the wave's cycles under the bell times 2 pi.
REACH, CYCLES = 7.0, 5.0

#: Numbers of a transform, and frames of signals, that are held at once, beyond a single signal.
AT_ONCE, SIGNALS = 1 << 20, 1 << 15


def frequencies(n: int, lowest: float, highest: float) -> tuple[float, ...]:
    """Rising, at equal steps of their logarithms."""
    return tuple(lowest * (highest / lowest) ** (i / (n - 1)) for i in range(n)) if n > 1 else (lowest,)


def spread(frequency: float) -> float:
    """Standard deviation in seconds of the bell for a frequency."""
    return (CYCLES + math.sqrt(2 + CYCLES**2)) / (4 * math.pi * frequency)


def factor(frequency: float, rate: float) -> float:
    """What makes waves of equal height equally strong at all frequencies, for sums over
    frames in the place of an integral."""
    s = spread(frequency)
    return math.pi**-0.25 * math.exp(0.25 * (CYCLES - math.sqrt(CYCLES**2 + 2)) ** 2) / math.sqrt(2) / (s * rate * math.sqrt(2 * math.pi))


def wavelet(frequency: float, rate: float) -> np.ndarray:
    """Conjugate of the wavelet at each frame, its middle at index len // 2."""
    s = spread(frequency)
    t = np.arange(-math.ceil(REACH * s * rate), math.ceil(REACH * s * rate) + 1) / rate / s
    return factor(frequency, rate) * np.exp(-0.5 * t * t - 1j * CYCLES * t)


@lru_cache(16)
def spectra(rate: float, of: tuple[float, ...], length: int) -> tuple[int, np.ndarray, list[int]]:
    """For signals of up to ``length`` frames: the size of their transforms, each wavelet's spectrum
    and half its length. What of a wavelet is farther out than such a signal is long meets none of
    its frames. The sum over frames around each is a convolution with the reversed wavelet."""
    kernels = []
    for f in of:
        k = wavelet(f, rate)
        cut = max(0, len(k) // 2 - (length - 1))
        kernels.append(k[cut : len(k) - cut])
    size = 1 << (length + max(map(len, kernels)) - 2).bit_length()
    return size, np.stack([np.fft.fft(k[::-1], size) for k in kernels]), [len(k) // 2 for k in kernels]


def amplitudes(x: np.ndarray, rate: float, of: tuple[float, ...]) -> np.ndarray:
    """Of signals with nothing before and after them, (signals, frames), as (signals, frames,
    frequencies)."""
    size, kernels, halves = spectra(rate, of, x.shape[1])
    out = np.empty((*x.shape, len(of)))
    step = max(1, AT_ONCE // (size * len(of)))
    for i in range(0, len(x), step):
        waves = np.fft.ifft(np.fft.fft(x[i : i + step], size)[:, None] * kernels)
        for j, half in enumerate(halves):
            out[i : i + step, :, j] = np.abs(waves[:, j, half : half + x.shape[1]])
    return out


def wavelet_features(df: DataFrame, trial: str, frame: str, channels: list[str], *, n: int = 25, lowest: float = 1.0, highest: float = 50.0, rate: float = 100.0, piece: int = 10_000) -> DataFrame:
    """trial, frame, ``power`` (the sum of all amplitudes of a frame) and ``share`` (for
    every channel in turn, for rising frequencies, an amplitude's part in it; 0 where
    the power is). Frames count from 0 without gaps; null and non-finite values are zeros."""
    of = frequencies(n, lowest, highest)
    border = max(len(wavelet(f, rate)) for f in of) // 2
    clean = lambda c: F.coalesce(F.when(F.abs(F.col(c)) < float("inf"), F.col(c)), F.lit(0.0)).cast("double")
    rows = df.select(F.col(trial).alias("trial"), F.col(frame).cast("long").alias("frame"), *[clean(c).alias(f"c{i}") for i, c in enumerate(channels)])
    # a frame goes to its own piece and to those whose border it is in
    at = F.sequence(F.greatest(F.floor((F.col("frame") - border) / piece), F.lit(0)), F.floor((F.col("frame") + border) / piece))
    dealt = rows.withColumn("piece", F.explode(at))
    names = [f"c{i}" for i in range(len(channels))]

    def some(rows: pa.RecordBatch, bounds: np.ndarray) -> pa.RecordBatch:
        values = np.stack([rows.column(c).to_numpy() for c in names])
        mine = rows.column("frame").to_numpy() // piece == rows.column("piece").to_numpy()
        got = np.empty((rows.num_rows, len(names) * len(of)))
        # signals of about one length are transformed at once
        lengths = np.diff(bounds)
        room = np.array([1 << int(m - 1).bit_length() for m in lengths])
        for size in np.unique(room):
            which = np.flatnonzero(room == size)
            for some in np.split(which, range(max(1, SIGNALS // size), len(which), max(1, SIGNALS // size))):
                inside = np.arange(size) < lengths[some][:, None]
                at = (bounds[some][:, None] + np.arange(size))[inside]
                for i in range(len(names)):
                    x = np.zeros((len(some), size))
                    x[inside] = values[i, at]
                    got[at, i * len(of) : (i + 1) * len(of)] = amplitudes(x, rate, of)[inside]
        got = got[mine]
        power = got.sum(1)
        share = got / np.where(power > 0, power, 1.0)[:, None]
        kept = rows.filter(pa.array(mine))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(got) + 1, dtype=np.int32) * got.shape[1]), pa.array(share.ravel()))
        return pa.RecordBatch.from_arrays([kept.column("trial"), kept.column("frame"), pa.array(power), lists], ["trial", "frame", "power", "share"])

    kind = dict(rows.dtypes)["trial"]
    got = map_groups(dealt, ["trial", "piece"], ["frame"], some, f"trial {kind}, frame long, power double, share array<double>")
    return got.withColumnsRenamed({"trial": trial, "frame": frame})


