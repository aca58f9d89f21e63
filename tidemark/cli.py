"""Command line: python -m tidemark.cli [mode] [--config FOLDER] [--params FILE].

Modes: --hash, --profile, --fft, --pipeline (the default), --pipeline-sha256, --stream; --train and --infer fit and apply a detector
(--source folder, spectra or fft); --sweep times the pipeline by numbers of workers; --generate and --send make recordings as
--params says, into a folder or as a load client; --clear empties the store.
"""

from __future__ import annotations

import argparse
import sys

from tidemark.config import EngineConfig
from tidemark.operators import anomaly
from tidemark.plans import modes
from tidemark.session import ship
from tidemark.sources.synthetic import generate, read_params
from tidemark.streaming import ingest

#: Modes in the order in which they win when several are given.
MODES = ("profile", "fft", "hash", "stream", "train", "infer", "sweep", "generate", "send", "clear", "pipeline_sha256", "pipeline")


def parse(args: list[str]) -> tuple[str, argparse.Namespace, list[str]]:
    """mode, options, arguments that mean nothing."""
    parser = argparse.ArgumentParser(prog="tidemark", allow_abbrev=False)
    for mode in MODES:
        parser.add_argument(f"--{mode.replace('_', '-')}", action="store_true")
    parser.add_argument("--grpc", dest="stream", action="store_true", help="as --stream")
    parser.add_argument("--config", default=".")
    parser.add_argument("--params", help="JSON of what --generate, --send or --sweep (workers, runs) is to do")
    parser.add_argument("--source", default="folder", choices=("folder", "spectra", "fft"), help="where --train and --infer take features from")
    parser.add_argument("--rate", type=float, help="payloads a second of --send")
    parser.add_argument("--list-params", action="store_true", help="print the configuration and stop")
    known, rest = parser.parse_known_args(args)
    mode = "list" if known.list_params else next((m for m in MODES if getattr(known, m)), "pipeline")
    return mode, known, rest


def main(args: list[str]) -> int:
    mode, options, rest = parse(args)
    for name in rest:
        print(f"unknown argument: {name}", file=sys.stderr)
    config = EngineConfig.find(options.config)
    if mode == "list":
        print("\n".join(f"{k} = {v}" for k, v in vars(config).items()))
        return 0
    params = read_params(options.params) if options.params else {}
    if mode in ("generate", "send"):
        if not params:
            print(f"--{mode} needs --params", file=sys.stderr)
            return 2
        if mode == "generate":
            print(f"{len(generate(params, params.get('output_dir', config.input_dir)))} recordings")
        else:
            print("sent {} of {}".format(*ingest.load(config.input_dir, params, options.rate)))
        return 0
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ship(spark)
    if mode == "stream":
        ingest.start_pipeline(spark, config, f"{config.output_dir}/checkpoint", once=False).awaitTermination()
    elif mode == "train":
        print("train: {train} rows to fit, {validation} held out, threshold {threshold}".format(**modes.run_train(spark, config, options.source)))
    elif mode == "infer":
        print("infer: {total} rows, {normal} normal, {anomalies} anomalies".format(**anomaly.summary(modes.run_infer(spark, config, options.source)).first().asDict()))
    elif mode == "sweep":
        modes.run_sweep(spark, config, tuple(params.get("workers", (2, 4, 8))), params.get("runs_per_config", 3)).show()
    elif mode == "clear":
        if config.store_path:
            modes.clear_store(spark, config.store_path)
    else:
        run = {"hash": modes.run_hash, "profile": modes.run_profile, "fft": modes.run_fft, "pipeline": modes.run_pipeline_fft, "pipeline_sha256": modes.run_pipeline_sha256}[mode]
        print(f"{mode}: {run(spark, config).count()} rows")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
