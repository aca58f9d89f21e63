"""Configuration: a dataclass, read from JSON where there is a file, with environment overrides for the store."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, replace
from pathlib import Path

CONFIG_FILE = "config.json"


@dataclass(frozen=True)
class EngineConfig:
    sample_rate: int = 44_100
    sha256_batch_size: int = 1024
    sha256_threads_per_block: int = 64
    fft_batch_size: int = 2048
    fft_threads_per_block: int = 256
    fft_size: int = 8192
    #: Scale of 16-bit samples: benchmarks divide by 32767, feature extraction by 32768.
    pcm_scale: float = 32_767.0
    reader_threads: int = 4
    verbose: bool = False
    store_host: str = "127.0.0.1"
    store_port: int = 6379
    store_db: int = 0
    #: Folder of the keyed tables; None runs without a store.
    store_path: str | None = None
    test_data_dir: str = "test_data"
    output_dir: str = "output"
    input_dir: str = "input"
    #: Folder of the fitted detector, and the window that its features are made of.
    model_dir: str = "model"
    feature_fft_size: int = 65_536

    def __post_init__(self) -> None:
        for name in ("sample_rate", "sha256_batch_size", "fft_batch_size", "fft_size", "reader_threads"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1")

    def batch_size(self, mode: str) -> int:
        return self.sha256_batch_size if mode == "sha256" else self.fft_batch_size

    @classmethod
    def load(cls, path: str | Path) -> EngineConfig:
        """From a JSON file. Sections file, kernels, redis and paths are required; without pipeline there is one reader."""
        path = Path(path)
        if not path.exists():
            raise FileNotFoundError(f"no configuration at {path}")
        root = json.loads(path.read_text())
        sha, fft, store, paths = root["kernels"]["sha256"], root["kernels"]["fft"], root["redis"], root["paths"]
        return cls(
            sample_rate=root["file"]["sample_rate"],
            sha256_batch_size=sha["batch_size"],
            sha256_threads_per_block=sha["threads_per_block"],
            fft_batch_size=fft["batch_size"],
            fft_threads_per_block=fft["threads_per_block"],
            fft_size=fft["fft_size"],
            reader_threads=root.get("pipeline", {"reader_threads": 1})["reader_threads"],
            verbose=root.get("verbose", False),
            store_host=store["host"],
            store_port=store["port"],
            store_db=store["db"],
            store_path=root.get("store_path"),
            test_data_dir=paths["test_data_dir"],
            output_dir=paths["output_dir"],
            input_dir=paths["input_dir"],
            model_dir=paths.get("model_dir", cls.model_dir),
            feature_fft_size=fft.get("feature_fft_size", cls.feature_fft_size),
        )

    @classmethod
    def find(cls, folder: str | Path) -> EngineConfig:
        """The folder's file if it has one, else the defaults; relative paths are taken from the folder."""
        folder = Path(folder).resolve()
        config = cls.load(folder / CONFIG_FILE) if (folder / CONFIG_FILE).exists() else cls()
        return replace(config, **{name: str(folder / getattr(config, name)) for name in ("test_data_dir", "output_dir", "input_dir", "model_dir")}).from_environment()

    def from_environment(self) -> EngineConfig:
        """REDIS_HOST and REDIS_PORT win over the file; a port that is no number is left out."""
        host, port = os.environ.get("REDIS_HOST", self.store_host), os.environ.get("REDIS_PORT", "")
        return replace(self, store_host=host, store_port=int(port) if port.isdigit() else self.store_port)
