from dataclasses import replace

import numpy as np
import pytest

from tidemark.config import EngineConfig
from tidemark.operators import anomaly
from tidemark.operators.metrics import StageTimes, stream_times
from tidemark.plans import modes
from tidemark.sources import synthetic
from tidemark.sources.recordings import scan_recordings
from tidemark.streaming import ingest

SIZES = [(1, "clean", 20_000, 0), (2, "clean", 20_000, 0), (3, "clean", 30_000, 0), (4, "anomaly", 20_000, 4), (5, "anomaly", 20_000, 5)]


@pytest.fixture()
def config(tmp_path):
    for i, kind, n, seed in SIZES:
        folder = tmp_path / "in" / ("sub" if i == 5 else "")
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"engine_{kind}_{i:05d}.wav").write_bytes(synthetic.wav_bytes(synthetic.to_pcm16(synthetic.signal(kind, n, seed=seed))))
    (tmp_path / "in" / "broken.wav").write_bytes(b"JUNK")
    return EngineConfig(input_dir=str(tmp_path / "in"), output_dir=str(tmp_path / "out"), store_path=str(tmp_path / "store"), fft_batch_size=2, sha256_batch_size=2)


def test_fft_pipeline_collapses_equal_spectra(spark, config):
    rows = modes.run_pipeline_fft(spark, config).collect()
    # the two clean recordings are equal, and the longer one has the same first window
    assert len(rows) == 3 and all(len(r["magnitudes"]) == 4097 for r in rows)
    modes.run_pipeline_fft(spark, config)
    store = modes.spectrum_store(spark, config.store_path)
    assert {r["xxhash"] for r in store.read().collect()} == {r["xxhash"] for r in rows}
    assert modes.registry(spark, config.store_path).read().count() == 0


def test_sha_pipeline_is_exact(spark, config):
    assert modes.run_pipeline_sha256(spark, config).count() == 4
    first = {r["sha256"]: r for r in modes.registry(spark, config.store_path).read().collect()}
    modes.run_pipeline_sha256(spark, config)
    again = {r["sha256"]: r for r in modes.registry(spark, config.store_path).read().collect()}
    assert len(again) == 4 and all(again[k]["first_seen"] == first[k]["first_seen"] and again[k]["last_seen"] > first[k]["last_seen"] for k in again)


def test_hash_mode(spark, config):
    with pytest.raises(Exception, match="RIFF"):
        modes.run_hash(spark, config)
    # the lesser path of the two equal recordings
    assert sorted(r["path"][-9:] for r in modes.run_hash(spark, config, "skip").collect()) == ["00001.wav", "00003.wav", "00004.wav", "00005.wav"]
    assert modes.run_hash(spark, config, "skip").count() == 0
    assert modes.run_hash(spark, replace(config, store_path=None), "skip").count() == 5
    written = spark.read.csv(f"{config.output_dir}/hash_results.csv", header=True)
    assert written.columns == ["sha256", "duration_ms"] and written.count() == 5


def test_fft_mode_looks_at_the_store_once_a_batch(spark, config):
    out = modes.run_fft(spark, config, "skip")
    # in path order the two equal recordings fall into different batches
    assert sorted(r["path"][-9:] for r in out.collect()) == ["00001.wav", "00003.wav", "00004.wav", "00005.wav"]
    assert modes.magnitude_store(spark, config.store_path).read().count() == 4
    assert modes.run_fft(spark, config, "skip").count() == 0


def test_profile_mode(spark, config, tmp_path):
    (tmp_path / "in" / "broken.wav").unlink()
    for _ in range(2):
        row = modes.run_profile(spark, config).first()
    assert row["total_files"] == 5 and row["throughput_files_per_sec"] > 0
    assert spark.read.csv(f"{config.output_dir}/profile_results.csv", header=True).count() == 2
    assert len(open(f"{config.output_dir}/profile_results.csv").readlines()) == 3  # one header


def test_empty_folder(spark, config, tmp_path):
    empty = replace(config, input_dir=str(tmp_path / "none"))
    assert modes.run_pipeline_fft(spark, empty).count() == 0 and modes.run_hash(spark, empty).count() == 0


def test_features_from_folder_and_store(spark, config):
    rows = modes.features_of_folder(spark, config.input_dir, fft_size=8192).collect()
    assert [r["key"] for r in rows] == sorted(r["key"] for r in rows) and len(rows) == 4 and len(rows[0]["features"]) == int(5000 * 8192 / 44_100) // 32
    modes.run_pipeline_fft(spark, config)
    store = modes.spectrum_store(spark, config.store_path)
    assert modes.features_of_store(spark, store, 65_536).count() == 0
    assert modes.features_of_store(spark, store, 8192, consume=True).count() == 3
    assert modes.features_of_store(spark, store, 8192).count() == 0 and store.read().count() == 3


def test_stream_of_a_landing_folder(spark, config, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    good = (tmp_path / "in" / "engine_clean_00001.wav").read_bytes()
    assert ingest.send(str(landing), b"") == (False, "empty payload")
    assert ingest.send(str(landing / "none"), good) == (False, "failed to open output file")
    assert ingest.send(str(landing), good) == (True, "ok") and ingest.send(str(landing), good)[0]
    own = replace(config, input_dir=str(landing))
    for _ in range(2):
        ingest.start_pipeline(spark, own, str(tmp_path / "checkpoint")).awaitTermination()
    assert modes.spectrum_store(spark, own.store_path).read().count() == 1
    ingest.send(str(landing), (tmp_path / "in" / "engine_anomaly_00004.wav").read_bytes())
    ingest.start_pipeline(spark, own, str(tmp_path / "checkpoint")).awaitTermination()
    assert modes.spectrum_store(spark, own.store_path).read().count() == 2
    with pytest.raises(ValueError):
        ingest.start_pipeline(spark, replace(own, store_path=None), str(tmp_path / "c2"))


def test_stage_times_and_sweep(spark, config):
    times = StageTimes()
    modes.run_pipeline_fft(spark, config, times=times)
    assert set(times.seconds) == {"scan", "compute", "store"} and times.counts["files"] == 6 and times.counts["bytes"] > 100_000 and "6 files" in times.report()
    rows = modes.run_sweep(spark, config, workers=(1, 2), runs=2).collect()
    assert len(rows) == 4 and {r["workers"] for r in rows} == {1, 2} and all(r["files"] == 6 and r["files_per_sec"] > 0 for r in rows)
    assert spark.read.csv(f"{config.output_dir}/baseline_fft.csv", header=True).count() == 4


def test_empty_payloads_are_rejected_by_the_stream(spark, config, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "1_a.wav").write_bytes(b"")
    (landing / "2_b.wav").write_bytes((tmp_path / "in" / "engine_clean_00001.wav").read_bytes())
    query = ingest.start_pipeline(spark, replace(config, input_dir=str(landing)), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    rejected = spark.read.parquet(f"{config.output_dir}/rejected").collect()
    assert [(r["path"][-7:], r["message"]) for r in rejected] == [("1_a.wav", "empty payload")]
    assert modes.spectrum_store(spark, config.store_path).read().count() == 1 and stream_times(query.lastProgress)["addBatch"] > 0


def test_clearing_empties_all_families(spark, config):
    modes.run_pipeline_fft(spark, config)
    modes.run_pipeline_sha256(spark, config)
    modes.clear_store(spark, config.store_path)
    assert modes.registry(spark, config.store_path).read().count() == 0 and modes.spectrum_store(spark, config.store_path).read().count() == 0


@pytest.mark.parametrize("detector", ["autoencoder", "components"])
def test_detection_from_recordings_to_verdicts(spark, tmp_path, detector):
    """200 clean recordings to train on; 30 anomalies and clean ones that were not seen: all 30 are found, and nothing else."""
    for kind, folder, count in (("clean", "train", 200), ("anomaly", "test", 30), ("clean", "test", 20)):
        (tmp_path / folder).mkdir(exist_ok=True)
        for i in range(count):
            n = (51_178, 60_000, 70_000, 90_000)[i % 4]
            # a recording starts anywhere in the engine's cycle, a little louder or softer
            x = np.roll(synthetic.signal(kind, n, seed=i), 37 * i) * (1 - 0.001 * (i % 7))
            (tmp_path / folder / f"engine_{kind}_{i:05d}.wav").write_bytes(synthetic.wav_bytes(synthetic.to_pcm16(x)))
    config = EngineConfig(input_dir=str(tmp_path / "train"), output_dir=str(tmp_path / "out"), model_dir=str(tmp_path / "model"), feature_fft_size=16_384)
    told = modes.run_train(spark, config, detector=detector, **({"epochs": 150} if detector == "autoencoder" else {}))
    assert (told["train"], told["validation"]) == (160, 40)
    rows = modes.run_infer(spark, replace(config, input_dir=str(tmp_path / "test"))).collect()
    assert len(rows) == 50 and {r["key"] for r in rows if r["anomaly"]} >= {f"engine_anomaly_{i:05d}.wav" for i in range(30)}
    assert sum(r["anomaly"] for r in rows) == 30
    with pytest.raises(anomaly.NotFitted):
        modes.run_infer(spark, replace(config, model_dir=str(tmp_path / "none")))


def test_ranges_give_what_whole_files_give(spark, config, tmp_path):
    """Headers of any length, short and damaged files: by ranges as by whole contents."""
    pcm = synthetic.to_pcm16(synthetic.signal("anomaly", 9000, seed=3))
    plain = synthetic.wav_bytes(pcm)
    extra = plain[:36] + b"LIST" + (6000).to_bytes(4, "little") + bytes(6000) + plain[36:]
    for name, data in (("long header", extra), ("100%", plain), ("short", synthetic.wav_bytes(pcm[:10])), ("cut", plain[:9000]), ("none", b"RIFF")):
        (tmp_path / "in" / f"{name}.wav").write_bytes(data)
    files = scan_recordings(spark, config.input_dir)
    told = lambda rows: sorted((r["path"], r["xxhash"]) for r in rows.collect())
    whole = told(modes.spectra(files, config))
    assert told(modes.spectra(files.drop("content"), config)) == whole and len(whole) == 8
    with pytest.raises(Exception, match="RIFF|beyond|not found"):
        modes.spectra(files.drop("content"), config, "fail").collect()
