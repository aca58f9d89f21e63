"""Spectra: magnitudes of real transforms, and what is read off them."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def magnitudes_of(payloads: list[bytes], fft_size: int, scale: float, channels: list[int] | None = None) -> np.ndarray:
    """float32 magnitudes, a row of fft_size // 2 + 1 for each payload of 16-bit samples, cut or padded to one window.

    With channels given only the left one counts; else samples are taken as they stand. The transform runs over all
    rows at once in single precision, as keys are hashes of its result.
    """
    window = np.zeros((len(payloads), fft_size), np.float32)
    for i, data in enumerate(payloads):
        step = channels[i] if channels else 1
        samples = np.frombuffer(data, "<i2", len(data) // 2)[::step][:fft_size]
        window[i, : len(samples)] = samples.astype(np.float32) / np.float32(scale)
    return np.abs(np.fft.rfft(window, axis=1)).astype(np.float32)


def magnitude_bytes(payload: Column, fft_size: int, scale: float, channels: Column | None = None, rows: int = 256) -> Column:
    """Magnitudes as little-endian float bytes, the form that is hashed. rows: transformed together."""

    def run(data: pd.Series, steps: list[int] | None) -> pd.Series:
        out: list[bytes] = []
        for at in range(0, len(data), rows):
            part = [b"" if x is None else bytes(x) for x in data.iloc[at : at + rows]]
            out += [m.tobytes() for m in magnitudes_of(part, fft_size, scale, None if steps is None else steps[at : at + rows])]
        return pd.Series(out)

    def as_they_stand(data: pd.Series) -> pd.Series:
        return run(data, None)

    def left_channel(data: pd.Series, step: pd.Series) -> pd.Series:
        return run(data, step.astype(int).tolist())

    return F.pandas_udf(as_they_stand, "binary")(payload) if channels is None else F.pandas_udf(left_channel, "binary")(payload, channels)


def _floats(data: pd.Series) -> pd.Series:
    return data.map(lambda b: None if b is None else np.frombuffer(b, "<f4"))


def floats_of(blob: Column) -> Column:
    """Array of the floats in a blob."""
    return F.pandas_udf(_floats, "array<float>")(blob)


def hz_to_bin(hz: Column, fft_size: int, sample_rate: int) -> Column:
    return F.floor(hz * fft_size / sample_rate)


def peak_near(mag: Column, center: Column, reach: int = 5) -> Column:
    """Largest magnitude within reach bins of the center, the window cut at both ends."""
    low = F.greatest(center - reach, F.lit(0))
    high = F.least(center + reach, F.size(mag) - 1)
    return F.array_max(F.slice(mag, (low + 1).cast("int"), (high - low + 1).cast("int")))


def loudest_bin(mag: Column) -> Column:
    """The first bin of the largest magnitude."""
    return F.array_position(mag, F.array_max(mag)) - 1


def nearest(values: Column, target: Column) -> Column:
    """Index of the value nearest to the target, the first of equals."""
    gaps = F.transform(values, lambda x: F.abs(x - target))
    return F.array_position(gaps, F.array_min(gaps)) - 1


def mean_of(mag: Column) -> Column:
    return F.aggregate(mag, F.lit(0.0), lambda s, x: s + x) / F.size(mag)


def stands_out(mag: Column, at: Column, times: float = 2.0) -> Column:
    """Whether a bin holds more than so many times the mean."""
    return F.element_at(mag, (at + 1).cast("int")) > times * mean_of(mag)


def max_difference(a: Column, b: Column) -> Column:
    return F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y)))


def peak_normalised(x: Column) -> Column:
    """x over its largest absolute value; silence stays as it is."""
    top = F.array_max(F.transform(x, F.abs))
    return F.when(top > 0, F.transform(x, lambda v: v / top)).otherwise(x)


def pcm16(x: Column) -> Column:
    """16-bit sample of a value: clipped to -1 and 1, times 32767, cut toward zero."""
    return (F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x)) * 32767).cast("smallint")


def preprocess(mag: Column, bin_max: int = 7430, bin_min: int = 0, factor: int = 32, size: int | None = None, log: bool = True) -> Column:
    """Features of a spectrum: the band, every factor-th bin, cut or padded with zeros to size, log1p."""
    size = (bin_max - bin_min) // factor if size is None else size
    band = F.slice(mag, bin_min + 1, bin_max - bin_min)
    value = lambda i: F.coalesce(F.try_element_at(band, i.cast("int") * factor + 1).cast("double"), F.lit(0.0))
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: (F.log1p(value(i)) if log else value(i)).cast("float"))


def dft_magnitudes(x: Column, n: int) -> Column:
    """Magnitudes of the n // 2 + 1 bins in double precision, by the definition: for short windows only, as work grows with n squared."""
    step = 2 * math.pi / n

    def part(k: Column, wave) -> Column:
        terms = F.transform(x, lambda v, i: v.cast("double") * wave(F.lit(step) * ((k * i) % n)))
        return F.aggregate(terms, F.lit(0.0), lambda s, v: s + v)

    def bin_of(k: Column) -> Column:
        return F.hypot(part(k, F.cos), part(k, F.sin))

    return F.transform(F.sequence(F.lit(0), F.lit(n // 2)), bin_of)
