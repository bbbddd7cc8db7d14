"""The job over a folder of scans: outputs, their validation, the failure log, attempts."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom import config
from rasterloom.operators import relational as rel
from rasterloom.operators import tiles
from rasterloom.plans import pipeline, tuning
from rasterloom.sources import files as sources
from rasterloom.sources import logs

ATTEMPTS, PAUSE_S = 10, 5.0
#: Images that a configuration is timed on, the largest ones.
TIMED_IMAGES = 5


def process(spark: SparkSession, root: str, output: str, log: str, upscaler: tiles.Upscaler = tiles.nearest, settings: config.Settings | None = None, first: bool = True) -> DataFrame:
    """Writes the upscaled and the finished images of all scans that have no finished one, and their failures to the log.

    Outputs keep their path below ``root``; they are read back, and one that is not a valid image fails its validation.
    Returns n, errors and success by folder, for the images that had no output before.
    """
    settings = settings or config.Settings()
    big, final = settings.outputs(output)
    done = _outputs(spark, final)
    result = pipeline.run(spark, root, done, upscaler, settings)
    written, scratch = {}, [result.scratch]
    for folder, images, step in ((big, result.upscaled, "super_resolution"), (final, result.images, "downscale")):
        parts = images.select("path", "relative_path", "ppi", "height", "width", "channels", "data", "error")
        made = sources.write_png(parts.where("data is not null"), folder, F.col("relative_path"), F.col("ppi"))
        none = {"path": F.lit(None).cast("string"), "bytes": F.lit(None).cast("long"), "error": F.coalesce("error", F.lit("no pixels"))}
        lost = parts.where("data is null").select(*(c.alias(n) for n, c in none.items()), F.col("path").alias("input"), "relative_path")
        scratch.append(f"{sources.shared_folder(spark)}/written-{uuid.uuid4().hex}")
        made.unionByName(lost).write.parquet(scratch[-1])  # once, so that files are written once
        written[step] = spark.read.parquet(scratch[-1])
    states = _states(spark, written, {"super_resolution": big, "downscale": final})
    failed = states.where("failed_step is not null").withColumn("now", F.current_timestamp())
    message = F.when(F.col("failed_step").startswith("validate"), F.concat(F.lit("Input image invalid: "), "error"))
    message = message.otherwise(F.concat(F.lit("Errore "), "failed_step", F.lit(": "), "error"))
    late = rel.failure_rows(failed, F.col("failed_step"), message, F.col("input"), "now")
    logs.append_failures(result.failures.unionByName(late), log, first)
    logs.rewrite_sorted(spark, log)
    late_by_folder = sources.with_path_parts(failed, "input").groupBy(F.col("parent").alias("__p")).agg(F.count("*").alias("late"))
    totals = result.totals.join(late_by_folder, F.col("parent") == F.col("__p"), "left")
    errors = F.col("errors") + F.coalesce("late", F.lit(0))
    totals = totals.select("parent", "n", errors.alias("errors"), (F.col("n") - errors).alias("success"))
    kept = f"{sources.shared_folder(spark)}/totals-{uuid.uuid4().hex}"
    totals.write.parquet(kept)
    for folder in scratch:
        sources.remove(spark, folder)
    return spark.read.parquet(kept)


def upscale(spark: SparkSession, folder: str, output: str, upscaler: tiles.Upscaler = tiles.nearest, settings: config.Settings | None = None, ppi: int | None = None) -> DataFrame:
    """Upscales the image files right in ``folder``, told by their suffix, to ``output``: page.png becomes page_x2.png.

    A resolution that is given grows with the images. Returns the rows of :func:`write_png`; what fails has an error.
    """
    settings = settings or config.Settings()
    own = sources.image_files(sources.files(spark, folder)).where(pipeline.relative(F.col("path"), folder) == F.col("name"))
    images = sources.images(spark, folder).join(own.select("path"), "path", "left_semi").where("data is not null")
    big = tiles.superresolved(images, upscaler, settings.scale, settings.tile, settings.overlap)
    name = sources.scaled_name(F.element_at(F.split("path", "/"), -1), settings.scale)
    grown = None if ppi is None else F.lit(ppi * settings.scale)
    return sources.write_png(big.where("data is not null"), output, name, grown)


def log_crash(spark: SparkSession, root: str, log: str, error: Exception) -> None:
    """A crash's row in the failure log."""
    row = spark.range(1).select(F.current_timestamp().alias("now"))
    message = F.lit(f"Unexpected error with {root}: {error}")
    logs.append_failures(rel.failure_rows(row, F.lit("CRASH"), message, F.lit(root), "now"), log)


@contextmanager
def progress(spark: SparkSession, report: Callable[[int, int], None], pause: float = 1.0) -> Iterator[None]:
    """Reports finished and all tasks of the stages that run, at each pause, until the block ends."""
    over = threading.Event()

    def watch() -> None:
        tracker = spark.sparkContext.statusTracker()
        while not over.wait(pause):
            found = [i for s in tracker.getActiveStageIds() if (i := tracker.getStageInfo(s))]
            report(sum(i.numCompletedTasks for i in found), sum(i.numTasks for i in found))

    watcher = threading.Thread(target=watch, daemon=True)
    watcher.start()
    try:
        yield
    finally:
        over.set()
        watcher.join()


def _outputs(spark: SparkSession, folder: str) -> DataFrame:
    """relative_path of the whole outputs below ``folder``, which need not be there."""
    if not sources.exists(spark, folder):
        return spark.createDataFrame([], "relative_path string")
    found = sources.files(spark, folder).where(~F.col("name").endswith(".part"))
    return found.select(pipeline.relative(F.col("path"), folder).alias("relative_path"))


def _states(spark: SparkSession, written: dict[str, DataFrame], folders: dict[str, str]) -> DataFrame:
    """(input, failed_step, error): the first step that each image failed at, if any, and why."""
    found = None
    for step, rows in written.items():
        folder = folders[step]
        valid = rows.select("input", "relative_path", F.lit(None).cast("string").alias("error")).limit(0)
        if rows.where("bytes is not null").limit(1).count():
            read = sources.files(spark, folder).withColumn("relative_path", pipeline.relative(F.col("path"), folder))
            valid = sources.validated(read, sources.images(spark, folder)).join(rows.where("bytes is not null").select("input", "relative_path"), "relative_path")
        valid = valid.select("input", F.col("error").alias(f"{step}_invalid"))
        both = rows.select("input", F.col("error").alias(f"{step}_error")).join(valid, "input", "left")
        found = both if found is None else found.join(both, "input", "full_outer")
    tests = {}
    for step in written:
        tests[step] = F.col(f"{step}_error").isNull()
        tests[f"validate_{step}"] = F.col(f"{step}_invalid").isNull()
    failed = pipeline.first_failure(tests)
    error = F.coalesce(*(F.col(f"{s}_{k}") for s in written for k in ("error", "invalid")))
    return found.select("input", failed.alias("failed_step"), error.alias("error"))


def attempts(run: Callable[[bool], DataFrame], most: int = ATTEMPTS, pause: float = PAUSE_S) -> DataFrame:
    """``run`` (the first attempt or not), again after a pause where it raises; the last error is raised.

    What an attempt has written counts as done in the next one.
    """
    for attempt in range(1, most + 1):
        try:
            return run(attempt == 1)
        except Exception:
            if attempt == most:
                raise
            time.sleep(pause)
    raise ValueError("no attempt")


def benchmark(spark: SparkSession, root: str, log: str, best: str, upscaler: tiles.Upscaler = tiles.nearest, settings: config.Settings | None = None) -> DataFrame:
    """Times each configuration that the log has not on the largest scans and writes the fastest; a process is a partition of tiles."""
    settings = settings or config.Settings()
    known = sources.exists(spark, log)
    empty = spark.createDataFrame([], "timestamp timestamp_ntz, device string, processes int, threads int, total_time double, avg_time double")
    before = logs.read_benchmarks(spark, log) if known else empty
    largest = sources.files(spark, root).orderBy(F.desc("length"), "path").limit(TIMED_IMAGES).select("path")
    images = sources.images(spark, root).join(F.broadcast(largest), "path", "left_semi").where("data is not null")

    def measure(device: str, processes: int, threads: int) -> tuple[float, float]:
        began = time.perf_counter()
        cut = tiles.split(images, settings.tile, settings.overlap).repartition(processes * threads)
        big = tiles.assembled(tiles.blended(tiles.upscaled(cut, upscaler, settings.scale, settings.tile), settings.scale, settings.tile, settings.overlap))
        count = big.where("data is not null").count()
        return tuning.timed(time.perf_counter() - began, count)

    after = tuning.tune(spark, before, measure, ["CPU"])
    new = after.join(before.select(*tuning.KEYS), tuning.KEYS, "left_anti")
    logs.append_benchmark(new, log)
    chosen = tuning.best(after.withColumn("__at", F.struct(*tuning.KEYS)), "__at")
    logs.write_best(chosen, best)
    return chosen
