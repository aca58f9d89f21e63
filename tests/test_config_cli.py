import json

import pytest

from tidemark import cli
from tidemark.config import EngineConfig
from tidemark.streaming import ingest

FULL = {
    "file": {"sample_rate": 8000}, "paths": {"test_data_dir": "t", "output_dir": "o", "input_dir": "i"},
    "kernels": {"sha256": {"batch_size": 7, "threads_per_block": 32}, "fft": {"batch_size": 9, "threads_per_block": 16, "fft_size": 1024}},
    "pipeline": {"reader_threads": 2}, "redis": {"host": "h", "port": 1, "db": 3}, "verbose": True,
}


def written(folder, **changes):
    path = folder / "config.json"
    path.write_text(json.dumps({k: v for k, v in (FULL | changes).items() if v is not None}))
    return path


def test_all_values_are_read(tmp_path):
    c = EngineConfig.load(written(tmp_path))
    assert (c.sample_rate, c.sha256_batch_size, c.fft_batch_size, c.fft_size, c.reader_threads) == (8000, 7, 9, 1024, 2)
    assert (c.store_host, c.store_port, c.store_db, c.verbose, c.input_dir) == ("h", 1, 3, True, "i")
    assert c.batch_size("sha256") == 7 and c.batch_size("fft") == 9


def test_optional_and_required_sections(tmp_path):
    c = EngineConfig.load(written(tmp_path, pipeline=None, verbose=None))
    assert c.reader_threads == 1 and not c.verbose
    for section in ("file", "kernels", "redis", "paths"):
        with pytest.raises(KeyError):
            EngineConfig.load(written(tmp_path, **{section: None}))
    with pytest.raises(FileNotFoundError):
        EngineConfig.load(tmp_path / "none.json")
    with pytest.raises(ValueError):
        EngineConfig.load(written(tmp_path, pipeline={"reader_threads": 0}))


def test_defaults_and_environment(tmp_path, monkeypatch):
    c = EngineConfig.find(tmp_path)
    assert (c.sample_rate, c.fft_size, c.sha256_batch_size, c.fft_batch_size, c.reader_threads) == (44_100, 8192, 1024, 2048, 4)
    assert c.input_dir == str(tmp_path / "input")
    monkeypatch.setenv("REDIS_HOST", "elsewhere")
    monkeypatch.setenv("REDIS_PORT", "77")
    assert (EngineConfig.find(tmp_path).store_host, EngineConfig.find(tmp_path).store_port) == ("elsewhere", 77)
    monkeypatch.setenv("REDIS_PORT", "x")
    assert EngineConfig.find(tmp_path).store_port == 6379


@pytest.mark.parametrize(
    "args,mode",
    [([], "pipeline"), (["--hash"], "hash"), (["--fft", "--hash"], "fft"), (["--profile", "--fft"], "profile"), (["--grpc", "--pipeline-sha256"], "stream"), (["--stream"], "stream"), (["--pipeline-sha256"], "pipeline_sha256"), (["--list-params", "--fft"], "list")],
)
def test_modes_and_their_rank(args, mode):
    assert cli.parse(args)[0] == mode


def test_unknown_arguments_are_named():
    mode, options, rest = cli.parse(["--what", "--config", "x"])
    assert (mode, options.config, rest) == ("pipeline", "x", ["--what"])


def test_recordings_by_parameters(tmp_path, capsys):
    (tmp_path / "landing").mkdir()
    made = {"sample_rate": 44100, "output_dir": str(tmp_path / "made"), "signals": [{"type": "clean", "size_kb": 2, "count": 2, "subdir": "a"}, {"type": "noisy", "size_kb": 2, "count": 9}, {"type": "anomaly", "size_kb": 3, "count": 1}]}
    (tmp_path / "signals.json").write_text(json.dumps(made))
    with pytest.warns(UserWarning, match="noisy"):
        assert cli.main(["--generate", "--params", str(tmp_path / "signals.json")]) == 0
    files = sorted(str(p.relative_to(tmp_path / "made")) for p in (tmp_path / "made").rglob("*.wav"))
    assert files == ["a/engine_clean_2kb_00001.wav", "a/engine_clean_2kb_00002.wav", "engine_anomaly_3kb_00001.wav"]
    listed = json.loads((tmp_path / "made" / "test_data_hashes.json").read_text())
    assert len(listed) == 3 and len(set(listed.values())) == 2
    sent = {"signal": {"sample_rate": 44100, "size_kb": 2}, "batch": {"clean": 2, "anomaly": 3}}
    assert ingest.load(str(tmp_path / "landing"), sent, rate=1000) == (5, 5) and len(list((tmp_path / "landing").glob("*.wav"))) == 5
    assert cli.main(["--send"]) == 2 and "needs --params" in capsys.readouterr().err
