"""WAV headers and PCM payloads of binary files."""

from __future__ import annotations

import re
import struct
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import HEADER

#: The header is looked for in so many bytes first; only if it does not end there, in the whole content.
PREFIX = 4096
FIELDS = ("sample_rate", "num_samples", "num_channels", "bit_depth", "data_offset", "data_size")


class HeaderError(ValueError):
    """Why a file is no PCM recording."""


def parse_header(data: bytes, length: int) -> dict[str, int]:
    """Fields of the header. data: the file or its beginning; length: of the whole file.

    Chunks are walked until fmt and data are found. A data chunk in front of fmt, one that ends beyond the file, no
    channels or fewer than 8 bits a sample are errors; so is every format but PCM.
    """
    if data[:4] != b"RIFF":
        raise HeaderError("missing RIFF")
    if data[8:12] != b"WAVE":
        raise HeaderError("missing WAVE")
    at, fmt = 12, None
    while at + 8 <= length:
        if at + 8 > len(data):
            raise IndexError
        name, size = data[at : at + 4], int.from_bytes(data[at + 4 : at + 8], "little")
        at += 8
        if name == b"fmt ":
            if at + 16 > length or size < 16:
                raise HeaderError("truncated fmt chunk")
            if at + 16 > len(data):
                raise IndexError
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", data, at)
            if kind != 1:
                raise HeaderError("only PCM is supported")
            if not channels or bits < 8:
                raise HeaderError("no channels or too few bits a sample")
            fmt = (rate, channels, bits)
        elif name == b"data":
            if fmt is None:
                raise HeaderError("data chunk before fmt chunk")
            if at + size > length:
                raise HeaderError("data chunk ends beyond the file")
            rate, channels, bits = fmt
            return {"sample_rate": rate, "num_samples": size // (bits // 8 * channels), "num_channels": channels, "bit_depth": bits, "data_offset": at, "data_size": size}
        at += size
    raise HeaderError("fmt chunk not found" if fmt is None else "data chunk not found")


def _headers(prefixes: pd.Series, lengths: pd.Series) -> pd.DataFrame:
    rows = []
    for data, length in zip(prefixes, lengths, strict=True):
        try:
            rows.append(parse_header(b"" if data is None else bytes(data), int(length)) | {"parse_error": None})
        except HeaderError as error:
            rows.append(dict.fromkeys(FIELDS) | {"parse_error": str(error)})
        except IndexError:
            rows.append(dict.fromkeys(FIELDS) | {"parse_error": "?"})
    return pd.DataFrame(rows, columns=[*FIELDS, "parse_error"])


def with_header(files: DataFrame) -> DataFrame:
    """files (content, length) with struct header; header.parse_error says what is wrong with a file.

    Only the first PREFIX bytes cross into Python; whole contents do for the rare files whose header is longer.
    """
    parse = F.pandas_udf(_headers, HEADER)
    first = files.withColumn("header", parse(F.substring("content", 1, PREFIX), F.col("length")))
    whole = F.when(F.col("header.parse_error") == "?", F.col("content"))
    second = first.withColumn("_again", parse(F.coalesce(whole, F.substring("content", 1, PREFIX)), F.col("length")))
    return second.withColumn("header", F.when(F.col("header.parse_error") == "?", F.col("_again")).otherwise(F.col("header"))).drop("_again")


def valid(files: DataFrame, on_error: str = "skip") -> DataFrame:
    """Rows whose header was read. on_error="fail" lets a bad file end the job, as the sequential modes do."""
    error = F.col("header.parse_error")
    if on_error == "fail":
        return files.where(F.when(error.isNotNull(), F.raise_error(F.concat(F.col("path"), F.lit(": "), error)).cast("boolean")).otherwise(True))
    if on_error != "skip":
        raise ValueError("on_error is skip or fail")
    return files.where(error.isNull())


def pcm(limit: int | None = None) -> Column:
    """The payload, or its first bytes: a JVM substring, so that the rest never leaves the scan."""
    size = F.col("header.data_size")
    size = size if limit is None else F.least(size, F.lit(limit))
    return F.substr(F.col("content"), (F.col("header.data_offset") + 1).cast("int"), size.cast("int"))


#: Stores that a worker can read ranges of by itself.
RANGED = ("file", "hdfs", "s3", "s3a", "gs")


def scheme_of(path: str) -> str:
    found = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", path)
    return found[1].lower() if found else "file"


@lru_cache(64)
def _store(scheme: str, authority: str):
    from pyarrow import fs

    if scheme == "file":
        return fs.LocalFileSystem()
    return fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{authority}/")[0]


def read_payload(path: str, length: int, limit: int) -> tuple[dict[str, int], bytes]:
    """Header and first bytes of the payload of a file, of which no more is read; HeaderError if it is no recording."""
    scheme, authority, at = scheme_of(path), "", re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:", "", path)
    if at.startswith("//"):
        authority, _, at = at[2:].partition("/")
        at = f"/{at}"
    if scheme in ("s3", "s3a", "gs"):
        at = f"{authority}{at}"
    with _store(scheme, authority).open_input_file(at) as file:
        data = file.read_at(min(length, PREFIX), 0)
        try:
            header = parse_header(data, length)
        except IndexError:
            data = file.read_at(length, 0)
            header = parse_header(data, length)
        begin, end = header["data_offset"], header["data_offset"] + min(header["data_size"], limit)
        return header, data[begin:end] if end <= len(data) else file.read_at(end - begin, begin)
