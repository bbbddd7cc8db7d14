"""Failure logs, benchmark logs and the best configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rasterloom import schema


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    """The failure log; older files without full_path have nulls there."""
    return spark.read.csv(path, header=True, schema=schema.FAILURE_LOG, mode="PERMISSIVE", enforceSchema=True)


def append_failures(rows: DataFrame, path: str, first: bool = False) -> None:
    """Appends log rows; the first write of a run replaces what was there."""
    columns = [c.split()[0] for c in schema.FAILURE_LOG.split(", ")]
    rows.select(*columns).write.mode("overwrite" if first else "append").csv(path, header=True)


def read_benchmarks(spark: SparkSession, path: str) -> DataFrame:
    """The benchmark log; a malformed average is null, a malformed number elsewhere is an error."""
    raw = spark.read.csv(path, header=True)
    return raw.select(
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        "device",
        F.col("processes").cast("int").alias("processes"),
        F.col("threads").cast("int").alias("threads"),
        F.col("total_time").try_cast("double").alias("total_time"),
        F.col("avg_time").try_cast("double").alias("avg_time"),
    )


def append_benchmark(rows: DataFrame, path: str) -> None:
    stamp = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp")
    total = F.format_string("%.2f", F.col("total_time").cast("double")).alias("total_time")
    average = F.format_string("%.4f", F.col("avg_time").cast("double")).alias("avg_time")
    rows.select(stamp, "device", "processes", "threads", total, average).write.mode("append").csv(path, header=True)


def write_best(config: DataFrame, path: str) -> None:
    config.select("device", "processes", "threads").coalesce(1).write.mode("overwrite").json(path)


def read_best(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path, schema=schema.BEST_CONFIG, multiLine=True)


def sorted_log(rows: DataFrame, crash_last: bool = False) -> DataFrame:
    """Log rows by time and file, crashes at the end if asked for."""
    first = [F.col("filename") == "CRASH"] if crash_last else []
    return rows.orderBy(*first, "timestamp", "filename")


def rewrite_sorted(spark: SparkSession, path: str, crash_last: bool = False) -> None:
    """The failure log at ``path`` rewritten in order, by way of a folder beside it, which stays if the swap is cut short."""
    beside = f"{path.rstrip('/')}.sorted"
    sorted_log(read_failures(spark, path), crash_last).coalesce(1).write.mode("overwrite").csv(beside, header=True)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    old, new = hadoop.Path(path), hadoop.Path(beside)
    files = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(old, True)
    files.rename(new, old)


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Adds rn, the place from 1 in the global order.

    Rows are ranked in time buckets whose counts are summed up, so no task ranks the whole log; the order's first column
    that is not boolean must be a timestamp as text, whose hour is the bucket.
    """
    stamp = next(c for c in order if dict(rows.dtypes)[c] == "string")
    lead = order[: order.index(stamp)]
    rows = rows.withColumn("__b", F.concat_ws("/", *[F.col(c).cast("string") for c in lead], F.substring(stamp, 1, 13)))
    counts = rows.groupBy("__b").agg(F.count("*").alias("__c"))
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(F.col("__b").alias("__k"), F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__base"))
    rank = F.row_number().over(Window.partitionBy("__b").orderBy(*order))
    joined = rows.withColumn("__r", rank).join(bases, F.col("__b") == F.col("__k"))
    return joined.withColumn("rn", F.col("__base") + F.col("__r")).drop("__b", "__k", "__base", "__r")
