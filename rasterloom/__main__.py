"""Command line: python -m rasterloom INPUT OUTPUT [--scale 2] [--model FILE] [--benchmark]."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from rasterloom import config
from rasterloom.operators import tiles
from rasterloom.plans import job
from rasterloom.sources import files as sources


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="rasterloom", description="Upscales and resizes folders of scans, or times configurations.")
    parser.add_argument("input")
    parser.add_argument("output")
    parser.add_argument("--scale", type=int, choices=(2, 3, 4), default=2)
    parser.add_argument("--model", help="a model file for onnxruntime; without it pixels are interpolated")
    parser.add_argument("--upscale-only", action="store_true", help="upscale the images right in the input folder, nothing else")
    parser.add_argument("--benchmark", action="store_true", help="time configurations only")
    parser.add_argument("--attempts", type=int, default=job.ATTEMPTS)
    parser.add_argument("--pause", type=float, default=job.PAUSE_S)
    options = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("rasterloom").getOrCreate()
    upscaler = tiles.OnnxUpscaler(options.model) if options.model else tiles.bicubic
    settings = config.Settings(options.scale)
    if options.upscale_only:
        failed = job.upscale(spark, options.input, options.output, upscaler, settings).where("error is not null").count()
        return 1 if failed else 0
    best, log = f"{options.output}/best_configuration", f"{options.output}/benchmark_log"
    if options.benchmark or not sources.exists(spark, best):
        job.benchmark(spark, options.input, log, best, upscaler, settings)
    if options.benchmark:
        return 0
    failures = f"{options.output}/processing_log"
    try:
        with job.progress(spark, lambda done, tasks: print(f"{done} of {tasks} tasks", file=sys.stderr)):
            totals = job.attempts(
                lambda first: job.process(spark, options.input, options.output, failures, upscaler, settings, first),
                options.attempts,
                options.pause,
            )
    except KeyboardInterrupt:
        return 0
    except Exception as error:  # noqa: BLE001
        job.log_crash(spark, options.input, failures, error)
        print(f"failed after {options.attempts} attempts: {error}", file=sys.stderr)
        return 1
    for r in totals.orderBy("parent").toLocalIterator():
        print(f"{r.parent}\t{r.n}\t{r.success}\t{r.errors}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
