"""Scans of recordings: directories, streams of a landing directory, and manifests."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import BINARY_FILE


def _folder(spark: SparkSession, folder: str):
    """The folder as Hadoop writes it, and whether it is one: any store that Spark reads will do."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    there = fs.exists(path)
    return (fs.resolvePath(path).toUri().getPath() if there else ""), there


def scan_recordings(spark: SparkSession, folder: str, depth: int | None = 1, with_content: bool = True) -> DataFrame:
    """path, modificationTime, length, content of the files that end in .wav (case counts), at most depth folders down; None: at any depth.

    A folder that is missing, or has no such file, gives no rows. Order is not defined; sort by path where it matters.
    """
    root, there = _folder(spark, folder)
    columns = [c.split()[0] for c in BINARY_FILE.split(", ") if with_content or not c.startswith("content")]
    if not there:
        return spark.createDataFrame([], BINARY_FILE).select(*columns)
    reader = spark.read.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", "*.wav").option("recursiveFileLookup", "true")
    files = reader.load(folder).select(*columns)
    if depth is not None:
        # paths are URIs whose scheme and authority differ between stores: what follows the folder is counted
        below = F.substr(F.regexp_replace("path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), F.lit(len(root.rstrip("/")) + 2))
        files = files.where(F.size(F.split(below, "/")) <= depth + 1)
    return files


def scan_sorted(spark: SparkSession, folder: str, depth: int | None = None) -> DataFrame:
    return scan_recordings(spark, folder, depth).orderBy("path")


def stream_recordings(spark: SparkSession, folder: str, files_a_batch: int | None = None) -> DataFrame:
    """The landing folder as a stream; senders put files there under a name of their own and rename them to .wav."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", "*.wav")
    return (reader if files_a_batch is None else reader.option("maxFilesPerTrigger", files_a_batch)).load(folder)


def union_of_producers(*parts: DataFrame) -> DataFrame:
    """Rows of all producers, each as often as it comes."""
    out, *rest = parts
    for part in rest:
        out = out.unionByName(part)
    return out


def read_manifest(spark: SparkSession, text: str) -> DataFrame:
    """file, sha256 of a JSON object."""
    one = spark.range(1).select(F.explode(F.from_json(F.lit(text), "map<string,string>")).alias("file", "sha256"))
    return one


def merge_manifests(old: str, new: str) -> str:
    """JSON of both, the new one's entries first in rank, sorted by file."""
    return json.dumps(json.loads(old or "{}") | json.loads(new or "{}"), indent=2, sort_keys=True)
