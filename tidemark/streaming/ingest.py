"""Streams: payloads sent to a landing folder, and the pipelines over it."""

from __future__ import annotations

import os
import time
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import EngineConfig
from tidemark.plans import modes
from tidemark.sources.recordings import stream_recordings
from tidemark.sources.synthetic import payloads


def send(folder: str, payload: bytes) -> tuple[bool, str]:
    """What a sender does on one machine: accepted, message. Payloads are not looked into, but must not be empty; files appear whole."""
    if not payload:
        return False, "empty payload"
    name = f"{int(time.time())}_{uuid.uuid4().hex[:6]}"
    try:
        part = Path(folder) / f".{name}.part"
        part.write_bytes(payload)
        os.replace(part, Path(folder) / f"{name}.wav")
    except OSError:
        return False, "failed to open output file"
    return True, "ok"


def load(folder: str, params: dict, rate: float | None = None) -> tuple[int, int]:
    """What a load client does: sends as many payloads of each kind as params say, at most rate a second; how many were accepted, and sent."""
    good = total = 0
    for _, payload in payloads(params):
        began = time.monotonic()
        good += send(folder, payload)[0]
        total += 1
        if rate:
            time.sleep(max(0.0, 1 / rate - (time.monotonic() - began)))
    return good, total


def reject_empty(spark: SparkSession, folder: str, log: str) -> list[str]:
    """Takes empty payloads out of the landing folder, where file sources pass them over in silence: renamed, and logged as path and message."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for status in fs.listStatus(at) if fs.exists(at) else []:
        path = status.getPath()
        if status.isFile() and path.getName().endswith(".wav") and status.getLen() == 0:
            fs.rename(path, path.suffix(".rejected"))
            gone.append(path.toString())
    if gone:
        spark.createDataFrame([(p, "empty payload") for p in gone], "path string, message string").coalesce(1).write.mode("append").parquet(log)
    return gone


def start_pipeline(spark: SparkSession, config: EngineConfig, checkpoint: str, mode: str = "fft", once: bool = True, interval: str = "5 seconds") -> StreamingQuery:
    """Runs a pipeline over the landing folder (config.input_dir) into the store. once: what is there, then stops; else until stopped.

    A micro-batch takes as many files as the mode's batch size says. Empty payloads are rejected at the start and with each micro-batch,
    into the folder rejected of the output.
    """
    if not config.store_path:
        raise ValueError("a stream needs a store")
    run = {"fft": modes.run_pipeline_fft, "sha256": modes.run_pipeline_sha256}[mode]

    def batch(files: DataFrame, _: int) -> None:
        reject_empty(spark, config.input_dir, rejected)
        run(spark, config, files.where("length > 0"))

    rejected = f"{config.output_dir}/rejected"
    reject_empty(spark, config.input_dir, rejected)
    writer = stream_recordings(spark, config.input_dir, config.batch_size(mode)).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def distinct_stream(rows: DataFrame, key: str, event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """First row of each key. Keys are kept for good, or, with an event time and a delay, for that long."""
    if event_time is None:
        return rows.dropDuplicates([key])
    return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
