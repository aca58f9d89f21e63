"""Distinct rows, upserts and look-ups by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import settled


def distinct_by(rows: DataFrame, key: str, order: str = "path") -> DataFrame:
    """One row for each key, that of the least order: an aggregation, combined before the shuffle, where a window would sort whole groups."""
    rest = [c for c in rows.columns if c != key]
    least = F.min_by(F.struct(*rest), F.struct(order)).alias("_row")
    return rows.groupBy(key).agg(least).select(key, "_row.*").select(*rows.columns)


def first_seen(rows: DataFrame, key: str, order: str = "path", store: DataFrame | None = None, dedup: bool = True) -> DataFrame:
    """Rows whose key is new: neither in the store nor in a row of lesser order. Without a store, dedup=False lets every row through."""
    if store is not None:
        rows = unseen(rows, store, key)
    return distinct_by(rows, key, order) if dedup else rows


def last_seen(rows: DataFrame, key: str | list[str], at: str) -> DataFrame:
    """key and the latest time it was written."""
    keys = [key] if isinstance(key, str) else key
    return rows.groupBy(*keys).agg(F.max(at).alias("last_seen"))


def batch_of(order: Column, size: int) -> Column:
    """Batch, from 1, of the place (from 1) that a row has."""
    return (F.floor((order - 1) / size) + 1).cast("long")


def batch_scoped(rows: DataFrame, key: str, batch: str = "batch", store: DataFrame | None = None) -> DataFrame:
    """Rows of the first batch that has their key; equal rows within one batch all stay, as the store is asked once a batch."""
    first = rows.groupBy(key).agg(F.min(batch).alias("_first"))
    kept = rows.join(first, key).where(F.col(batch) == F.col("_first")).drop("_first").select(*rows.columns)
    return kept if store is None else unseen(kept, store, key)


def unseen(rows: DataFrame, store: DataFrame, key: str) -> DataFrame:
    return rows.join(store.select(key), key, "left_anti")


def seen(rows: DataFrame, store: DataFrame, key: str) -> DataFrame:
    return rows.join(store.select(key), key, "left_semi")


def exists(keys: DataFrame, store: DataFrame, key: str) -> DataFrame:
    """keys with found, whether the store has each."""
    return keys.join(store.select(key).distinct().withColumn("_there", F.lit(True)), key, "left").select(*keys.columns, F.coalesce("_there", F.lit(False)).alias("found"))


def look_up(rows: DataFrame, store: DataFrame, key: str) -> DataFrame:
    """rows with the store's columns, null where the key is missing."""
    return rows.join(store, key, "left")


def ordered_split(rows: DataFrame, order: str, share: float = 0.2) -> DataFrame:
    """rows with part: validation for the last rows in order, max(1, floor(share n)) of them, train for the others.

    The place of a row comes from counts of the parts that sorting makes, so that no task sees all rows.
    """
    placed = numbered(rows, order)
    n = placed.agg(F.count("*").alias("n"))
    tail = F.greatest(F.lit(1), F.floor(F.col("n") * share))
    return placed.crossJoin(F.broadcast(n)).withColumn("part", F.when(F.col("place") <= F.col("n") - tail, "train").otherwise("validation")).drop("n", "place")


def numbered(rows: DataFrame, order: str, name: str = "place") -> DataFrame:
    """rows with their place, from 1, in the order of a unique column of any type.

    Rows are dealt to ranges of the order and sorted there; a row's place is its number within its range, shifted by the counts
    of the ranges before it. No task sees all rows, and no more than a count for each range reaches the driver.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # numbered and written at once, as ranges come from a sample and another run may draw others; above bit 33 the id holds the range
    dealt = rows.repartitionByRange(parts, order).sortWithinPartitions(order).withColumn("_id", F.monotonically_increasing_id())
    dealt = settled(dealt)
    counts = {r["_range"]: r["count"] for r in dealt.groupBy(F.shiftright("_id", 33).alias("_range")).count().collect()}
    before, shifts = 0, [F.lit(-1).cast("long"), F.lit(0).cast("long")]
    for k in sorted(counts):
        shifts += [F.lit(k).cast("long"), F.lit(before).cast("long")]
        before += counts[k]
    own = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return dealt.withColumn(name, own + F.create_map(*shifts)[F.shiftright("_id", 33)]).drop("_id")
