"""Makes the package importable in Python workers of any cluster."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors, once for each application; needless where PYTHONPATH, which workers inherit, has it."""
    context = spark.sparkContext
    on_path = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    if context.applicationId in _shipped or str(ROOT.parent) in on_path:
        return
    at = Path(tempfile.mkdtemp(prefix="tidemark-")) / "tidemark.zip"
    with zipfile.ZipFile(at, "w") as archive:
        for file in sorted(ROOT.rglob("*.py")):
            archive.write(file, file.relative_to(ROOT.parent))
    context.addPyFile(str(at))
    _shipped.add(context.applicationId)


#: Rows of an Arrow batch, unless the session says otherwise: with texts of a few kB, Spark's default makes batches of tens of MB on both sides.
BATCH_ROWS = "1000"


def bound_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, BATCH_ROWS)


def shipped(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The query, after the package was sent and batches were bounded."""

    @wraps(query)
    def run(spark: SparkSession, *args, **kwargs) -> DataFrame:
        ship(spark)
        bound_batches(spark)
        return query(spark, *args, **kwargs)

    return run


def work_folder(spark: SparkSession) -> str:
    """The folder that executors share, spark.checkpoint.dir. Where that is unset, one of our own if all runs on this machine, as in tests; else an error."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at


def settled(rows: DataFrame) -> DataFrame:
    """rows, computed once and kept in the shared folder. A cache would be lost with its executor, and would answer later plans that look alike."""
    at = f"{work_folder(rows.sparkSession)}/settled-{uuid4().hex}"
    rows.write.parquet(at)
    return rows.sparkSession.read.schema(rows.schema).parquet(at)
