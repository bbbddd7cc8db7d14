"""Helpers that the operators share."""

from __future__ import annotations

import tempfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lower-cases A-Z in UTF-8 and nothing else.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A key is hot if it holds more than this share of all rows, so there are no more hot keys than its inverse.
HOT_SHARE = 1e-4


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share.

    In local mode a temporary folder does where the setting is missing; on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="rasterloom-")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once, with its lineage cut, in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def hot_join(rows: DataFrame, classes: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``classes``, one row for each ``key`` and ``n`` of the ``total`` rows with it.

    Rows of a hot key meet its class by a broadcast of the hot classes, 1 / ``HOT_SHARE`` at most; all others, no key of
    which fills a task, by a shuffle.
    """
    hot = classes.where(F.col(n) > HOT_SHARE * total)
    cold = classes.where(F.col(n) <= HOT_SHARE * total)
    marked = rows.join(F.broadcast(hot), key, "left")
    few = marked.where(F.col(n).isNotNull())
    rest = marked.where(F.col(n).isNull()).select(*rows.columns).join(cold, key)
    return few.unionByName(rest)


def remainder(doc_id: int | None, divisor: int) -> int:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % divisor


def remainder_column(doc_id: str, divisor: int):
    """:func:`remainder` as a column."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % divisor


def sub_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that each holds about ``limit`` bytes of ``column``, or one row."""
    for batch in batches:
        values = batch.column(column)
        start = size = 0
        for row, length in enumerate(pa.compute.binary_length(values).to_pylist()):
            size += length or 0
            if size >= limit:
                yield batch.slice(start, row + 1 - start)
                start, size = row + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)
