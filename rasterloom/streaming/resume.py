"""Streams over a folder of incoming files: each file is seen once, whatever happens between runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rasterloom.sources.files import with_path_parts

_FILES = "path string, modificationTime timestamp, length long, content binary"


def incoming(spark: SparkSession, root: str, pattern: str = "*", max_files: int = 1000) -> DataFrame:
    """A stream of new files with path parts."""
    stream = spark.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", True)
    stream = stream.option("pathGlobFilter", pattern).option("maxFilesPerTrigger", max_files)
    return with_path_parts(stream.load(root))


def resume(spark: SparkSession, root: str, checkpoint: str, process: Callable[[DataFrame, int], None], pattern: str = "*") -> int:
    """Hands files that came since the last run to ``process`` (batch, number) and returns how many rows there were.

    A batch that failed comes again under its number, so ``process`` must replace what it wrote for that number.
    """
    query = (
        incoming(spark, root, pattern)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(process)
        .start()
    )
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def failure_stream(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """A stream of log rows written as CSV files into ``folder``."""
    return spark.readStream.schema(schema).option("header", True).csv(folder)


def drained(rows: DataFrame, path: str, checkpoint: str) -> None:
    """Appends what has arrived in a stream to the Parquet log at ``path``, each row once, and ends."""
    query = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    query.awaitTermination()
