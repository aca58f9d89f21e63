"""What the training-data operators share: tables, lineage cuts and hashing."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import work_folder

#: Words end at these characters, as a Java and as a Python pattern: space and tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def rows_a_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows at most for what is computed inside: Spark bounds batches by rows only, and some rows here are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cut(df: DataFrame, label: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends there, and a lost executor costs nothing already written."""
    at = f"{work_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def drop_cut(df: DataFrame) -> None:
    """Deletes the files of a cut that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark._jvm
    for file in df.inputFiles()[:1]:
        folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of phases that are over: it acts when the driver collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def with_key(docs: DataFrame, column: str = "text") -> DataFrame:
    """doc_id and a column for a pandas operator; the id is text there, as pandas has no exact 64-bit integers beside nulls."""
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), column)


def as_bytes(column: str = "text"):
    """The column in UTF-8, null as empty: Python gets bytes, whose split() and lower() know ASCII only."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 over uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASE = np.uint64(0xD1342543DE82EF95)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse; they are kept, and grow with the longest text."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        for k, base in enumerate((BASE, BASE_INVERSE)):
            _powers[k] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base)]))
    return _powers[0][:n], _powers[1][:n]


def range_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A polynomial of the values from start to end, for each of these. It only selects candidates: unlike values may collide by construction."""
    up, down = powers(len(values) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[:-1])])
    return (total[end] - total[start]) * down[start]


def hash_words(texts: list[bytes], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """64 bits (xxh3) of each word of all texts, one after the other, and where each text's words begin (and the last one's end).

    Other seeds give other hashes; two seeds make 128 bits.
    """
    words = [t.split() for t in texts]
    bounds = np.cumsum([0, *map(len, words)])
    if seed:
        hashes = (xxhash.xxh3_64_intdigest(w, seed) for own in words for w in own)
    else:
        hashes = map(xxhash.xxh3_64_intdigest, chain.from_iterable(words))
    return np.fromiter(hashes, np.uint64, int(bounds[-1])), bounds


def slices(texts, chars: int = 1_000_000):
    """Index ranges of consecutive texts with about so many bytes together, so that memory does not follow the Arrow batch."""
    first = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= chars:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)
