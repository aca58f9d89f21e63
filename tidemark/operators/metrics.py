"""Counts, rates and parameter sweeps."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class StageTimes:
    """Seconds of the stages of a run, and counts of the rows that went through, observed while they do and not counted again."""

    def __init__(self) -> None:
        self.seconds: dict[str, float] = {}
        self._seen: Observation | None = None

    @contextmanager
    def stage(self, name: str) -> Iterator[None]:
        began = time.perf_counter()
        try:
            yield
        finally:
            self.seconds[name] = self.seconds.get(name, 0.0) + time.perf_counter() - began

    def watched(self, rows: DataFrame, *counts: Column) -> DataFrame:
        if rows.isStreaming:
            return rows
        self._seen = Observation()
        return rows.observe(self._seen, *counts)

    @property
    def counts(self) -> dict[str, int]:
        """What was observed, 0 where there was nothing; to be asked for when the stage that reads the rows is over."""
        return {} if self._seen is None else {k: v or 0 for k, v in self._seen.get.items()}

    @property
    def total(self) -> float:
        return sum(self.seconds.values())

    def report(self) -> str:
        parts = [f"{name} {seconds:.3f} s" for name, seconds in self.seconds.items()]
        return ", ".join([*parts, f"total {self.total:.3f} s", *(f"{v} {k}" for k, v in self.counts.items())])


def stream_times(progress: dict | None) -> dict[str, float]:
    """Seconds by stage of a micro-batch, of the progress of a streaming query."""
    return {name: ms / 1000 for name, ms in ((progress or {}).get("durationMs") or {}).items()}


def rate(count: Column, seconds: Column) -> Column:
    """count a second; null where no time passed."""
    return count / F.nullif(seconds, F.lit(0.0))


def outcome_counts(rows: DataFrame, status: str = "status") -> DataFrame:
    counted = lambda name: F.count_if(F.col(status) == name).alias(name)
    return rows.agg(counted("processed"), counted("skipped"), counted("error"))


def batch_durations(rows: DataFrame, batch: str = "batch", duration: str = "duration_ms") -> DataFrame:
    """total_files, total_duration_ms, avg_batch_duration_ms, throughput_files_per_sec over batches."""
    each = rows.groupBy(batch).agg(F.count("*").alias("files"), F.max(duration).alias("ms"))
    total = each.agg(F.sum("files").alias("total_files"), F.sum("ms").alias("total_duration_ms"), F.avg("ms").alias("avg_batch_duration_ms"))
    return total.withColumn("throughput_files_per_sec", rate(F.col("total_files"), F.col("total_duration_ms") / 1000))


def bound_by(compute: Column, memory: Column) -> Column:
    """What limits a kernel, by its two utilisations."""
    return F.when((compute < 0) | (memory < 0) | compute.isNull() | memory.isNull(), "unknown").when(compute > memory, "compute").otherwise("memory")


def number_in(line: Column, last: bool = True) -> Column:
    """The last, or first, number of a line of a report, thousands separated or not; -1 if there is none."""
    found = F.regexp_extract_all(F.replace(line, F.lit(","), F.lit("")), F.lit(r"(?<![A-Za-z0-9.])-?[0-9]+(?:\.[0-9]+)?(?![A-Za-z0-9.])"), F.lit(0))
    return F.coalesce(F.try_element_at(found, F.lit(-1 if last else 1)).cast("double"), F.lit(-1.0))


def sweep(spark: SparkSession, **parameters: list[int]) -> DataFrame:
    """Every combination of the parameters' values."""
    out = None
    for name, values in parameters.items():
        own = spark.createDataFrame([(v,) for v in values], f"{name} long")
        out = own if out is None else out.crossJoin(F.broadcast(own))  # a few values each
    return out
