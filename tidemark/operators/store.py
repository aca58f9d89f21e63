"""Keyed tables: an append-only log of parts, read as the newest state of each key.

A write adds a part, a folder of its own, and never rewrites what a reader may be reading. ``compact``, ``delete`` and ``clear``
publish a generation: a base with the state of some parts, and the list of the parts that went into it. Readers take the
newest whole generation and all whole parts that are not in its list, so a part that arrives while a generation is made is
not lost. Parts are ordered by the writer's clock; equal times are told apart by the part's name.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ABSORBED = "part string"


class KeyedStore:
    """family: sha256 registries, magnitudes by sha256, spectra by xxhash; families never mix."""

    def __init__(self, spark: SparkSession, path: str, family: str, key: str, schema: str):
        self.spark, self.key = spark, key
        self.at = f"{path.rstrip('/')}/{family}"
        self.schema = spark.createDataFrame([], schema).schema
        self.logged = T.StructType([*self.schema.fields, T.StructField("_written", T.LongType()), T.StructField("_part", T.StringType())])

    def _whole(self, below: str, last: str = "") -> list[str]:
        """Names of the folders below that were written to their end."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        at = hadoop(f"{self.at}/{below}")
        fs = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(at):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(at)]
        return sorted(n for n in names if fs.exists(hadoop(f"{self.at}/{below}/{n}{last}/_SUCCESS")))

    def _state(self) -> tuple[str | None, list[str], set[str]]:
        """The newest generation, the parts behind it, and those in it."""
        found = self._whole("generations", "/absorbed")
        newest = found[-1] if found else None
        absorbed = set()
        if newest:
            listed = self.spark.read.schema(ABSORBED).parquet(f"{self.at}/generations/{newest}/absorbed")
            absorbed = {r["part"] for r in listed.collect()}  # one for each write so far
        return newest, [p for p in self._whole("parts") if p not in absorbed], absorbed

    def _log(self, newest: str | None, parts: list[str]) -> DataFrame:
        folders = [f"{self.at}/parts/{p}" for p in parts] + ([f"{self.at}/generations/{newest}/base"] if newest else [])
        return self.spark.read.schema(self.logged).parquet(*folders) if folders else self.spark.createDataFrame([], self.logged)

    def log(self) -> DataFrame:
        return self._log(*self._state()[:2])

    def _read(self, newest: str | None, parts: list[str]) -> DataFrame:
        rest = [f.name for f in self.schema.fields if f.name != self.key]
        last = self._log(newest, parts).groupBy(self.key).agg(
            F.max_by(F.struct(*rest, "_written"), F.struct("_written", "_part")).alias("_row"), *([F.min("first_seen").alias("_first")] if "first_seen" in rest else [])
        )
        columns = [F.col(self.key)] + [(F.col("_first") if c == "first_seen" else F.col(f"_row.{c}")).alias(c) for c in rest]
        return last.select(*columns, F.col("_row._written").alias("_written"))

    def read(self) -> DataFrame:
        """The newest state: one row for each key. first_seen, where there is one, is the oldest of the log."""
        return self._read(*self._state()[:2]).drop("_written")

    def set(self, rows: DataFrame) -> None:
        """Upsert: rows win over what is stored. Of equal keys in one write any row may win; make them distinct first where that matters."""
        at, name = time.time_ns(), uuid.uuid4().hex
        part = f"{at:020d}-{name}"
        marked = rows.select(*(F.col(f.name).cast(f.dataType) for f in self.schema.fields)).withColumns({"_written": F.lit(at), "_part": F.lit(part)})
        marked.write.parquet(f"{self.at}/parts/{part}")

    def keys(self) -> DataFrame:
        return self.read().select(self.key)

    def get(self, key: str) -> dict | None:
        row = self.read().where(F.col(self.key) == key).first()
        return None if row is None else row.asDict()

    def exists(self, key: str) -> bool:
        return not self.keys().where(F.col(self.key) == key).isEmpty()

    def _publish(self, keep) -> None:
        """A generation with what keep leaves of the state, in place of the generation before and the parts read here."""
        newest, parts, absorbed = self._state()
        at = f"{self.at}/generations/{time.time_ns():020d}"
        keep(self._read(newest, parts)).withColumn("_part", F.lit("")).select(*self.logged.fieldNames()).write.parquet(f"{at}/base")
        done = sorted(absorbed.union(parts))
        self.spark.createDataFrame([(p,) for p in done], ABSORBED).coalesce(1).write.parquet(f"{at}/absorbed")

    def compact(self) -> None:
        self._publish(lambda rows: rows)

    def clear(self) -> None:
        """Empties this family."""
        self._publish(lambda rows: rows.where(F.lit(False)))

    def mark_consumed(self, keys: DataFrame) -> None:
        """Rows of these keys as read; they stay in the store."""
        self.set(self.read().join(keys.select(self.key), self.key, "left_semi").withColumn("consumed", F.lit(True)))

    def delete(self, keys: DataFrame) -> None:
        """A generation without these keys."""
        gone = keys.select(self.key).distinct()
        self._publish(lambda rows: rows.join(gone, self.key, "left_anti"))
