import hashlib
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.functions import hashing, spectral, wav
from tidemark.sources import recordings, synthetic

#: Published digests of two clean recordings and of simple buffers.
CLEAN = {500: "9f0148e8d4556e5cd1fed78881d28d86160ae9606b57129a2b5726d536d3701e", 1024: "a1b34dade37a9e14622bc08da1ff5330a994ef470f66c8a6086c21ba8c69fd0a"}


def chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body


def fmt(kind=1, channels=1, rate=44_100, bits=16, extra=b"") -> bytes:
    return chunk(b"fmt ", struct.pack("<HHIIHH", kind, channels, rate, rate * channels * bits // 8, channels * bits // 8, bits) + extra)


def riff(*chunks: bytes) -> bytes:
    body = b"WAVE" + b"".join(chunks)
    return b"RIFF" + struct.pack("<I", len(body)) + body


PCM = struct.pack("<5h", 0, 1000, -1000, 32767, -32767)
FILES = {
    "good": riff(fmt(), chunk(b"data", PCM)), "extended": riff(fmt(extra=b"\0\0"), chunk(b"LIST", b"x" * 10), chunk(b"data", PCM)), "stereo": riff(fmt(channels=2), chunk(b"data", PCM[:8])),
    "far": riff(chunk(b"JUNK", b"j" * 6000), fmt(), chunk(b"data", PCM)), "empty_data": riff(fmt(), chunk(b"data", b"")),
    "bad_magic": b"JUNK" + riff(fmt())[4:], "bad_wave": riff(fmt()).replace(b"WAVE", b"EVAW"), "float": riff(fmt(kind=3), chunk(b"data", PCM)), "no_data": riff(fmt()), "no_fmt": riff(chunk(b"LIST", b"ab")),
    "data_first": riff(chunk(b"data", PCM), fmt()), "beyond": riff(fmt(), b"data" + struct.pack("<I", 999) + PCM), "no_channels": riff(fmt(channels=0), chunk(b"data", PCM)), "few_bits": riff(fmt(bits=4), chunk(b"data", PCM)),
    "tiny": b"RI", "nothing": b"",
}
GOOD = {"good", "extended", "stereo", "far", "empty_data"}


@pytest.fixture()
def files(spark):
    return spark.createDataFrame([(k, bytearray(v), len(v)) for k, v in FILES.items()], "path string, content binary, length long")


def test_headers(files):
    rows = {r["path"]: r for r in wav.with_header(files).withColumn("pcm", wav.pcm()).collect()}
    assert {k for k, r in rows.items() if r["header"]["parse_error"] is None} == GOOD
    assert bytes(rows["good"]["pcm"]) == bytes(rows["far"]["pcm"]) == bytes(rows["extended"]["pcm"]) == PCM and bytes(rows["empty_data"]["pcm"]) == b""
    header = rows["good"]["header"]
    assert (header["sample_rate"], header["num_samples"], header["num_channels"], header["bit_depth"], header["data_offset"], header["data_size"]) == (44_100, 5, 1, 16, 44, 10)
    assert rows["stereo"]["header"]["num_samples"] == 2
    assert "RIFF" in rows["bad_magic"]["header"]["parse_error"] and "PCM" in rows["float"]["header"]["parse_error"]


def test_bad_files_are_skipped_or_fatal(files):
    assert {r["path"] for r in wav.valid(wav.with_header(files)).select("path").collect()} == GOOD
    with pytest.raises(Exception, match="bad|missing|found|PCM|beyond|before|channels"):
        wav.valid(wav.with_header(files), "fail").count()
    with pytest.raises(ValueError):
        wav.valid(wav.with_header(files), "what")


def test_scan_depth(spark, tmp_path):
    for name in ("root.wav", "100kb/sub.wav", "100kb/deep/deep.wav", "notes.json", "loud.WAV"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(FILES["good"])
    names = lambda df: [r["path"].rsplit("/", 1)[1] for r in df.collect()]
    assert sorted(names(recordings.scan_recordings(spark, str(tmp_path)))) == ["root.wav", "sub.wav"]
    assert names(recordings.scan_recordings(spark, str(tmp_path), depth=0)) == ["root.wav"]
    assert names(recordings.scan_sorted(spark, str(tmp_path))) == ["deep.wav", "sub.wav", "root.wav"]
    assert recordings.scan_recordings(spark, str(tmp_path / "missing")).count() == 0
    pruned = recordings.scan_recordings(spark, str(tmp_path), with_content=False)
    assert "content" not in pruned.columns and pruned.count() == 2


@pytest.mark.parametrize("size", sorted(CLEAN))
def test_clean_recordings_have_the_published_digests(size):
    pcm = synthetic.to_pcm16(synthetic.signal("clean", synthetic.samples_for(size)))
    assert hashlib.sha256(pcm).hexdigest() == CLEAN[size]


def test_synthetic_signals():
    clean, odd = (synthetic.signal(k, 65_536, seed=1) for k in synthetic.SIGNALS)
    assert np.abs(clean).max() == np.abs(odd).max() == 1.0
    assert (synthetic.signal("anomaly", 100, seed=1) == synthetic.signal("anomaly", 100, seed=1)).all()
    assert synthetic.samples_for(500) == 255_978 and synthetic.samples_for(0) == 1
    assert np.frombuffer(synthetic.to_pcm16(np.array([-2.0, -1.0, 0.5, 2.0])), "<i2").tolist() == [-32767, -32767, 16383, 32767]
    assert len(synthetic.wav_bytes(b"\0" * 10)) == 54
    with pytest.raises(ValueError):
        synthetic.signal("noisy", 10)


def test_digests(spark):
    data = [bytes(64), bytes(256), bytes(1024), bytes(i % 256 for i in range(1024)), b"\xaa\x55" * 512, b"\xff" * 1024, b"hello world12345678901234567890abcdefgh", b"", None]
    df = spark.createDataFrame([(i, None if b is None else bytearray(b)) for i, b in enumerate(data)], "i int, b binary")
    rows = df.select("i", hashing.sha256_hex(F.col("b")).alias("s"), hashing.xxh64_hex(spark, F.col("b")).alias("x"), F.pandas_udf(hashing._xxh64, "string")("b").alias("y")).orderBy("i").collect()
    assert [(r["s"], r["x"]) for r in rows] == [(None, None) if b is None else (hashlib.sha256(b).hexdigest(), xxhash.xxh64_hexdigest(b)) for b in data]
    assert rows[6]["x"] == rows[6]["y"] == "4963646407701307"
    words = df.where("i = 0").select(hashing.words_of_sha256(hashing.sha256_hex(F.col("b"))).alias("w")).withColumn("again", hashing.hex_of_words(F.col("w"))).first()
    assert words["again"] == hashlib.sha256(data[0]).hexdigest() and int(words["w"][3]) == int(words["again"][48:], 16)
    assert df.select(hashing.words_of_sha256(F.lit("ab")).alias("w")).first()["w"] is None


def test_spectra(spark):
    n = 65_536
    pcm = {k: synthetic.to_pcm16(synthetic.signal(k, n + 5000, seed=2)) for k in synthetic.SIGNALS}
    short = pcm["clean"][:2000]
    df = spark.createDataFrame([("clean", bytearray(pcm["clean"])), ("twin", bytearray(pcm["clean"])), ("anomaly", bytearray(pcm["anomaly"])), ("short", bytearray(short))], "name string, pcm binary")
    mags = df.select("name", spectral.magnitude_bytes(F.col("pcm"), n, 32_767.0).alias("b")).withColumn("mag", spectral.floats_of(F.col("b")))
    rows = {r["name"]: np.array(r["mag"]) for r in mags.select("name", "mag").collect()}
    assert all(len(m) == n // 2 + 1 and (m >= 0).all() and np.isfinite(m).all() and m.any() for m in rows.values())
    assert (rows["clean"] == rows["twin"]).all() and (rows["clean"] == spectral.magnitudes_of([pcm["clean"]], n, 32_767.0)[0]).all()
    peaks = mags.select("name", spectral.loudest_bin(F.col("mag")).alias("loudest"), spectral.peak_near(F.col("mag"), F.lit(118)).alias("at80"), spectral.peak_near(F.col("mag"), F.lit(2006)).alias("at1350"), spectral.peak_near(F.col("mag"), F.lit(0)).alias("edge"))
    found = {r["name"]: r for r in peaks.collect()}
    assert abs(found["clean"]["loudest"] - 119) <= 1 and abs(found["anomaly"]["loudest"] - 2006) <= 1
    assert found["anomaly"]["at1350"] > 10 * found["clean"]["at1350"]
    assert found["clean"]["edge"] == pytest.approx(rows["clean"][:6].max())
    padded = np.zeros(n, np.float32)
    padded[:1000] = np.frombuffer(short, "<i2") / np.float32(32_767)
    assert np.abs(rows["short"] - np.abs(np.fft.rfft(padded))).max() < 1e-2
    assert spark.range(1).select(spectral.hz_to_bin(F.lit(80), n, 44_100), spectral.hz_to_bin(F.lit(1350), n, 44_100)).first()[:] == (118, 2006)


def test_left_channel_and_scale():
    both = np.array([[100, 7], [200, 7], [300, 7]], "<i2").tobytes()
    left = spectral.magnitudes_of([both], 4, 32_768.0, [2])
    assert np.allclose(left, np.abs(np.fft.rfft(np.array([100, 200, 300, 0]) / 32_768)), atol=1e-7)


def test_features(spark):
    mag = [float(k) for k in range(8000)]
    df = spark.createDataFrame([(1, mag), (2, mag[:100]), (3, [])], "i int, mag array<float>")
    rows = {r["i"]: r["f"] for r in df.select("i", spectral.preprocess(F.col("mag")).alias("f")).collect()}
    assert len(rows[1]) == len(rows[2]) == 232
    assert np.allclose(rows[1], np.log1p(np.arange(232) * 32), atol=1e-5)
    assert np.allclose(rows[2], [*np.log1p([0, 32, 64, 96]), *[0] * 228], atol=1e-6) and not any(rows[3])


def test_window_expressions(spark):
    row = spark.range(1).select(
        spectral.pcm16(F.lit(-1.5)), spectral.pcm16(F.lit(0.99999)), spectral.nearest(F.array(F.lit(1.0), F.lit(3.0), F.lit(2.0)), F.lit(2.4)), spectral.max_difference(F.array(F.lit(1.0), F.lit(5.0)), F.array(F.lit(2.0), F.lit(1.0))),
        spectral.peak_normalised(F.array(F.lit(1.0), F.lit(-4.0))), spectral.peak_normalised(F.array(F.lit(0.0))), spectral.stands_out(F.array(F.lit(1.0), F.lit(9.0), F.lit(1.0)), F.lit(1)),
    ).first()
    assert tuple(row) == (-32767, 32766, 2, 4.0, [0.25, -1.0], [0.0], True)


def test_manifests(spark):
    merged = recordings.merge_manifests('{"a": "1", "b": "2"}', '{"b": "3"}')
    assert {r["file"]: r["sha256"] for r in recordings.read_manifest(spark, merged).collect()} == {"a": "1", "b": "3"}
