"""The ways to run: hash, profile, fft, and the two pipelines, over a folder of recordings.

Each is a plan of DataFrames; work that can be left out is left out before Python sees the data: payloads are cut to one
window in the JVM, and recordings that were seen are dropped before their transform.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import EngineConfig
from tidemark.functions.hashing import sha256_hex, xxh64_hex
from tidemark.functions.spectral import floats_of, magnitude_bytes, magnitudes_of, preprocess
from tidemark.functions.wav import RANGED, HeaderError, pcm, read_payload, scheme_of, valid, with_header
from tidemark.operators import anomaly, dedup
from tidemark.operators.metrics import StageTimes, batch_durations
from tidemark.operators.store import KeyedStore
from tidemark.schemas import MAGNITUDES, SPECTRA
from tidemark.session import settled
from tidemark.sources.recordings import scan_recordings

REGISTRY = "sha256 string, first_seen timestamp, last_seen timestamp"


def registry(spark: SparkSession, path: str) -> KeyedStore:
    return KeyedStore(spark, path, "sha256", "sha256", REGISTRY)


def magnitude_store(spark: SparkSession, path: str) -> KeyedStore:
    return KeyedStore(spark, path, "fft", "sha256", MAGNITUDES)


def spectrum_store(spark: SparkSession, path: str) -> KeyedStore:
    return KeyedStore(spark, path, "spectra", "xxhash", SPECTRA)


def digests(files: DataFrame, on_error: str = "skip") -> DataFrame:
    """path, sha256 of the payload."""
    return valid(with_header(files), on_error).select("path", sha256_hex(pcm()).alias("sha256"))


def spectra(files: DataFrame, config: EngineConfig, on_error: str = "skip") -> DataFrame:
    """path, xxhash and mag_bytes of each recording, samples taken as they stand in the file.

    Of files without content, in a store that workers can read by themselves, header and window are read and no more; else
    Spark reads whole files, and windows are cut in the JVM.
    """
    if "content" in files.columns:
        window = pcm(2 * config.fft_size)
        rows = valid(with_header(files), on_error).select("path", magnitude_bytes(window, config.fft_size, config.pcm_scale, rows=config.fft_batch_size).alias("mag_bytes"))
    else:
        rows = files.select("path", "length").mapInPandas(ranged_spectra(config.fft_size, config.pcm_scale, config.fft_batch_size, on_error), "path string, mag_bytes binary")
    return rows.withColumn("xxhash", xxh64_hex(files.sparkSession, F.col("mag_bytes")))


def ranged_spectra(fft_size: int, scale: float, batch: int, on_error: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for at in range(0, len(rows), batch):
                paths, windows = [], []
                for path, length in rows.iloc[at : at + batch].itertuples(index=False):
                    try:
                        windows.append(read_payload(path, length, 2 * fft_size)[1])
                        paths.append(path)
                    except HeaderError as error:
                        if on_error == "fail":
                            raise HeaderError(f"{path}: {error}") from error
                yield pd.DataFrame({"path": pd.Series(paths, dtype=object), "mag_bytes": [m.tobytes() for m in magnitudes_of(windows, fft_size, scale)]})

    return run


def pipeline_fft(files: DataFrame, config: EngineConfig) -> DataFrame:
    """Default pipeline: one row for each spectrum, xxhash, fft_size, magnitudes."""
    rows = spectra(files, config)
    # grouped on the key before the floats are unpacked
    one = rows.groupBy("xxhash").agg(F.any_value("mag_bytes").alias("mag_bytes"))
    return one.select("xxhash", F.lit(config.fft_size).alias("fft_size"), floats_of(F.col("mag_bytes")).alias("magnitudes"))


def pipeline_sha256(files: DataFrame) -> DataFrame:
    """One row for each payload: sha256, first_seen and last_seen, of the files' times."""
    rows = valid(with_header(files)).select(sha256_hex(pcm()).alias("sha256"), "modificationTime")
    return rows.groupBy("sha256").agg(F.min("modificationTime").alias("first_seen"), F.max("modificationTime").alias("last_seen"))


def run_pipeline_fft(spark: SparkSession, config: EngineConfig, files: DataFrame | None = None, times: StageTimes | None = None) -> DataFrame:
    """Spectra of the input folder (or of files), written to the store if there is one; the distinct rows, computed once."""
    return _run_pipeline(spark, config, files, times, lambda rows: pipeline_fft(rows, config), _store_spectra)


def run_pipeline_sha256(spark: SparkSession, config: EngineConfig, files: DataFrame | None = None, times: StageTimes | None = None) -> DataFrame:
    return _run_pipeline(spark, config, files, times, pipeline_sha256, _store_digests)


def _store_spectra(spark: SparkSession, path: str, rows: DataFrame) -> None:
    now = F.current_timestamp()
    spectrum_store(spark, path).set(rows.select("xxhash", "fft_size", "magnitudes", F.lit(False).alias("consumed"), now.alias("first_seen"), now.alias("last_seen")))


def _store_digests(spark: SparkSession, path: str, rows: DataFrame) -> None:
    now = F.current_timestamp()
    registry(spark, path).set(rows.select("sha256", now.alias("first_seen"), now.alias("last_seen")))


def _run_pipeline(spark, config, files, times, compute, store) -> DataFrame:
    times = StageTimes() if times is None else times
    with times.stage("scan"):
        files = scan_recordings(spark, config.input_dir) if files is None else files
        if compute is not pipeline_sha256 and scheme_of(config.input_dir) in RANGED:
            files = files.drop("content")  # before the rows are observed, which would have Spark read it
    with times.stage("compute"):
        rows = settled(compute(times.watched(files, F.count("*").alias("files"), F.sum("length").alias("bytes"))))
    if config.store_path:
        with times.stage("store"):
            store(spark, config.store_path, rows)
    if config.verbose:
        print(times.report())
    return rows


def clear_store(spark: SparkSession, path: str) -> None:
    """Empties all families."""
    for family in (registry, magnitude_store, spectrum_store):
        family(spark, path).clear()


def append_csv(rows: DataFrame, path: str) -> None:
    """A few rows at the end of one file, whose header stands once."""
    spark = rows.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    text = spark.read.text(path, wholetext=True).first()["value"] if fs.exists(at) else ",".join(rows.columns) + "\n"
    text += "".join(",".join("" if v is None else str(v) for v in row) + "\n" for row in rows.collect())
    stream = fs.create(at, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def run_sweep(spark: SparkSession, config: EngineConfig, workers: tuple[int, ...] = (2, 4, 8), runs: int = 3) -> DataFrame:
    """The FFT pipeline without a store by so many tasks at once; workers, run, files, total_s, files_per_sec of each, also in baseline_fft.csv."""
    from dataclasses import replace

    rows = []
    for n in workers:
        for k in range(runs):
            times = StageTimes()
            files = scan_recordings(spark, config.input_dir).coalesce(n)
            run_pipeline_fft(spark, replace(config, store_path=None, verbose=False), files, times)
            files_ = times.counts["files"]
            rows.append((n, k + 1, files_, times.total, files_ / max(times.total, 1e-9)))
    out = spark.createDataFrame(rows, "workers int, run int, files long, total_s double, files_per_sec double")
    append_csv(out.orderBy("workers", "run"), f"{config.output_dir}/baseline_fft.csv")
    return out


def run_hash(spark: SparkSession, config: EngineConfig, on_error: str = "fail") -> DataFrame:
    """sha256, path of recordings not seen before; hash_results.csv in the output folder. Without a store every file is given."""
    began = time.perf_counter()
    rows = digests(scan_recordings(spark, config.input_dir), on_error)
    store = registry(spark, config.store_path) if config.store_path else None
    new = dedup.first_seen(rows, "sha256", "path", store.read() if store else None, dedup=store is not None)
    new = settled(new.select("sha256", "path"))
    n = new.count()
    share = (time.perf_counter() - began) * 1000 / max(1, n)
    new.select("sha256", F.round(F.lit(share), 3).alias("duration_ms")).write.mode("overwrite").csv(f"{config.output_dir}/hash_results.csv", header=True)
    if store:
        now = F.current_timestamp()
        store.set(new.select("sha256", now.alias("first_seen"), now.alias("last_seen")))
    return new


def run_profile(spark: SparkSession, config: EngineConfig) -> DataFrame:
    """Timing of hashing alone, in batches of the configured size; appended to profile_results.csv."""
    files = scan_recordings(spark, config.input_dir)
    began = time.perf_counter()
    rows = settled(digests(files, "fail"))
    n = rows.count()
    ms = (time.perf_counter() - began) * 1000
    placed = dedup.numbered(rows, "path").withColumn("batch", dedup.batch_of(F.col("place"), config.sha256_batch_size))
    batches = max(1, -(-n // config.sha256_batch_size))
    out = batch_durations(placed.withColumn("duration_ms", F.lit(ms / batches)))
    out = out.select(F.lit(config.sha256_threads_per_block).alias("threads_per_block"), F.lit(config.sha256_batch_size).alias("batch_size"), "*")
    append_csv(out, f"{config.output_dir}/profile_results.csv")
    return out


def run_fft(spark: SparkSession, config: EngineConfig, on_error: str = "fail") -> DataFrame:
    """Spectra by sha256 of recordings not stored yet: batches in path order, one look at the store for each; fft_results.csv."""
    began = time.perf_counter()
    files = scan_recordings(spark, config.input_dir)
    rows = dedup.numbered(digests(files, on_error), "path").withColumn("batch", dedup.batch_of(F.col("place"), config.fft_batch_size))
    store = magnitude_store(spark, config.store_path) if config.store_path else None
    new = dedup.batch_scoped(rows, "sha256", store=store.read() if store else None) if store else rows
    # contents are joined again by path, after the filter and cut to one window: the shuffle never holds whole recordings
    window = valid(with_header(files), on_error).select("path", pcm(2 * config.fft_size).alias("window"))
    joined = new.select("path", "sha256").join(window, "path")
    magnitudes = floats_of(magnitude_bytes(F.col("window"), config.fft_size, config.pcm_scale, rows=config.fft_batch_size)).alias("magnitudes")
    out = settled(joined.select("path", "sha256", F.lit(config.fft_size).alias("fft_size"), magnitudes))
    n = out.count()
    ms = max((time.perf_counter() - began) * 1000 / max(1, n), 1e-3)
    times = out.select(F.round(F.lit(ms), 3).alias("duration_ms"), F.round(F.lit(1000 / ms), 1).alias("throughput_files_per_sec"))
    times.write.mode("overwrite").csv(f"{config.output_dir}/fft_results.csv", header=True)
    if store:
        store.set(out.dropDuplicates(["sha256"]).select("sha256", "fft_size", "magnitudes"))
    return out


def features_of_folder(spark: SparkSession, folder: str, fft_size: int = 65_536, sample_rate: int = 44_100, max_hz: int = 5000) -> DataFrame:
    """key, features of the recordings of one folder, by path: left channel, 16-bit samples over 32768."""
    files = valid(with_header(scan_recordings(spark, folder, depth=0)))
    window = F.substr(F.col("content"), (F.col("header.data_offset") + 1).cast("int"), F.least(F.col("header.data_size"), 2 * fft_size * F.col("header.num_channels")).cast("int"))
    mags = files.select("path", floats_of(magnitude_bytes(window, fft_size, 32_768.0, F.col("header.num_channels"))).alias("mag"))
    features = preprocess(F.col("mag"), bin_max=int(max_hz * fft_size / sample_rate))
    return mags.select(F.element_at(F.split("path", "/"), -1).alias("key"), features.alias("features")).orderBy("key")


def features_of_store(spark: SparkSession, store: KeyedStore, fft_size: int, sample_rate: int = 44_100, max_hz: int = 5000, consume: bool = False) -> DataFrame:
    """key, features of stored spectra of that size not consumed yet; others are left out. consume marks them as read."""
    rows = store.read().where(F.size("magnitudes") == fft_size // 2 + 1)
    if "consumed" in rows.columns:
        rows = rows.where(~F.coalesce("consumed", F.lit(False)))
    out = rows.select(F.col(store.key).alias("key"), preprocess(F.col("magnitudes"), bin_max=int(max_hz * fft_size / sample_rate)).alias("features"))
    if consume:
        out = settled(out)
        store.mark_consumed(out.select(F.col("key").alias(store.key)))
    return out


def _features(spark: SparkSession, config: EngineConfig, source: str, consume: bool) -> DataFrame:
    if source == "folder":
        return features_of_folder(spark, config.input_dir, config.feature_fft_size, config.sample_rate)
    if source not in ("spectra", "fft"):
        raise ValueError("source is folder, spectra or fft")
    if not config.store_path:
        raise ValueError("features of a store need a store")
    store = spectrum_store(spark, config.store_path) if source == "spectra" else magnitude_store(spark, config.store_path)
    return features_of_store(spark, store, config.feature_fft_size, config.sample_rate, consume=consume and source == "spectra")


def run_train(spark: SparkSession, config: EngineConfig, source: str = "folder", detector: str = "autoencoder", **options) -> dict:
    """Fits a detector to the features of a source and saves it with its threshold in config.model_dir.

    Rows are split in order of their keys; the detector is fitted to the first ones, and the threshold is of the errors of those
    of the last ones that are named clean, of all of them if none is. Gives counts and the threshold.
    """
    rows = settled(_features(spark, config, source, consume=True))
    if rows.isEmpty():
        raise ValueError("no features to train on")
    parts = settled(dedup.ordered_split(rows, "key"))
    train, held = parts.where("part = 'train'").drop("part"), parts.where("part = 'validation'").drop("part")
    if train.isEmpty():
        train = held
    model = anomaly.fit_autoencoder(train, held, **options) if detector == "autoencoder" else anomaly.Components.fit(train, **options)
    threshold = anomaly.threshold_of(anomaly.score(anomaly.clean_rows(held), model)).first()["threshold"]
    anomaly.save(spark, config.model_dir, model, threshold)
    return {"train": train.count(), "validation": held.count(), "threshold": threshold}


def run_infer(spark: SparkSession, config: EngineConfig, source: str = "folder", consume: bool = False) -> DataFrame:
    """key, error, anomaly of a source's features by the saved detector; also in inference_results.csv."""
    model, threshold = anomaly.load(spark, config.model_dir)
    errors = anomaly.score(_features(spark, config, source, consume), model)
    out = settled(anomaly.flag(errors, spark.createDataFrame([(threshold,)], "threshold double")).select("key", "error", "anomaly"))
    out.write.mode("overwrite").csv(f"{config.output_dir}/inference_results.csv", header=True)
    return out
