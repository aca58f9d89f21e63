"""Digests and keys."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def sha256_hex(data: Column) -> Column:
    """64 lower-case hexadecimal digits."""
    return F.sha2(data, 256)


def words_of_sha256(digest: Column) -> Column:
    """The four unsigned 64-bit words of a digest; null if it is not 64 digits long."""
    word = lambda i: F.conv(F.substr(digest, F.lit(1 + 16 * i), F.lit(16)), 16, 10).cast("decimal(20,0)")
    return F.when(F.length(digest) == 64, F.array(*(word(i) for i in range(4))))


def hex_of_words(words: Column) -> Column:
    """64 digits of four words, the first word first."""
    return F.array_join(F.transform(words, lambda w: F.lpad(F.lower(F.conv(w.cast("string"), 10, 16)), 16, "0")), "")


def _xxh64(data: pd.Series) -> pd.Series:
    import xxhash

    return data.map(lambda b: None if b is None else xxhash.xxh64_hexdigest(b))


def xxh64_hex(spark: SparkSession, data: Column) -> Column:
    """xxHash64 with seed 0 of a binary column, 16 digits. Spark's own function has seed 42; its expression takes any."""
    try:
        jvm = spark._jvm
        utils = jvm.org.apache.spark.sql.classic.ExpressionUtils
        children = jvm.org.apache.spark.api.python.PythonUtils.toSeq([utils.expression(data._jc)])
        from pyspark.sql.classic.column import Column as ClassicColumn

        value = ClassicColumn(utils.column(jvm.org.apache.spark.sql.catalyst.expressions.XxHash64(children, 0)))
    except (AttributeError, TypeError):  # a Connect session has no JVM here
        return F.pandas_udf(_xxh64, "string")(data)
    return F.when(data.isNotNull(), F.lower(F.lpad(F.hex(value), 16, "0")))


def iso_time(ts: Column) -> Column:
    """Seconds of a timestamp as 19 characters, without a zone; sessions run in UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
