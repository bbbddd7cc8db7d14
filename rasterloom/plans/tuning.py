"""Configuration search: a grid, minus what was measured, with an early stop, down to the fastest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom import config, schema
from rasterloom.operators import relational as rel

GRID = {"device": ["CPU", "GPU"], "processes": [1, 2, 4, 8], "threads": [1, 2, 4, 8]}
KEYS = ["device", "processes", "threads"]


def best(log: DataFrame, ordinal: str) -> DataFrame:
    """The configuration with the smallest average time, the first of equals; rows without a time do not count."""
    picked = F.min_by(F.struct(*KEYS, "avg_time"), F.struct("avg_time", ordinal))
    return log.where("avg_time is not null").agg(picked.alias("r")).where("r is not null").select("r.*")


def pending(spark: SparkSession, log: DataFrame, devices: list[str] | None = None) -> DataFrame:
    """Configurations not measured yet, in grid order; no CPU ones once a CPU average has passed the limit."""
    grid = rel.grid(spark.range(1), **(GRID | ({"device": devices} if devices else {})))
    rows = rel.pending(grid, log, KEYS)
    slow = log.where((F.col("device") == "CPU") & (F.col("avg_time") > config.EARLY_STOP_S)).limit(1).count() > 0
    return (rows.where("device <> 'CPU'") if slow else rows).orderBy(*KEYS)


def timed(seconds: float, images: int) -> tuple[float, float]:
    """Total and average time of a run over ``images`` images; no images have no average."""
    return seconds, seconds / images if images else float("nan")


def tune(spark: SparkSession, log: DataFrame, measure: Callable[[str, int, int], tuple[float, float]], devices: list[str] | None = None) -> DataFrame:
    """The log with what ``measure`` (device, processes, threads) returned as (total_time, avg_time) for each new one."""
    rows, slow = [], False
    for r in pending(spark, log, devices).collect():  # bounded by the grid
        if r.device == "CPU" and slow:
            continue
        total, average = measure(r.device, r.processes, r.threads)
        slow = slow or (r.device == "CPU" and average > config.EARLY_STOP_S)
        rows.append((r.device, r.processes, r.threads, float(total), float(average)))
    new = spark.createDataFrame(rows, "device string, processes int, threads int, total_time double, avg_time double")
    new = new.withColumn("timestamp", F.current_timestamp().cast("timestamp_ntz"))
    names = [c.split()[0] for c in schema.BENCHMARK_LOG.split(", ")]
    return log.select(*names).unionByName(new.select(*names))
