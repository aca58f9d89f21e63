"""Schemas of files, recordings and keyed tables; nothing is inferred."""

from pyspark.sql import types as T

BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"
HEADER = "struct<sample_rate:bigint,num_samples:bigint,num_channels:int,bit_depth:int,data_offset:bigint,data_size:bigint,parse_error:string>"
REGISTRY = T.StructType([T.StructField("sha256", T.StringType()), T.StructField("first_seen", T.TimestampType()), T.StructField("last_seen", T.TimestampType())])
SPECTRA = "xxhash string, fft_size int, magnitudes array<float>, consumed boolean, first_seen timestamp, last_seen timestamp"
MAGNITUDES = "sha256 string, fft_size int, magnitudes array<float>"
SCORES = "key string, error double, anomaly boolean"
