"""Corpus pipeline: language ID, SimHash near-dedup, secret scans, mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir), docs being what the stage before it kept, and is written as Parquet and read
again by the next one. All but the last return the columns of documents.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rasterloom.llm import langid, mixing, packing, secrets, simhash
from rasterloom.llm.common import shared_folder


#: Batches between Spark and Python: whole texts are long, and an executor holds several batches of each task.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def _small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``stage`` in a session with ``BATCHES``, which hold until its rows are written."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for key, value in BATCHES.items():
            spark.conf.set(key, value)
        return stage(spark, docs, sf_dir)

    return run


@_small_batches
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose text has a language."""
    return langid.identified(docs, langid.fit(docs))


@_small_batches
def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near copies the document with the smallest id."""
    return simhash.deduplicated(docs)


@_small_batches
def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks the secrets in all texts."""
    return secrets.redacted(docs)


@_small_batches
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes words from each source up to its target weight; a document taken over again comes in several rows."""
    return mixing.Mix(docs).documents()


@_small_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts the documents' tokens into sequences of power-of-two lengths."""
    return packing.digest(packing.packed(docs, packing.default_tokenizer()))


STAGES = [("language_id", language), ("simhash_dedup", dedup), ("secret_scan", redact), ("mix_sources", mix), ("pack", pack)]
#: SQL can express neither the models nor the draws of these stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written below the shared folder; a stage's rows go once the next one's are there."""
    folder = f"{shared_folder(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    settings = {key: spark.conf.get(key) for key in BATCHES}
    try:
        for number, (name, stage) in enumerate(STAGES):
            path = f"{folder}/{number}-{name}"
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
            if before:
                _remove(spark, before)
            before = path
    finally:
        for key, value in settings.items():
            spark.conf.set(key, value)
    return docs


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
