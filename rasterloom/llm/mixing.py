"""Mixing sources to target weights.

The words of each source, its documents one after another, form blocks of fixed length. Output shards draw how many
slots each source gets from a multinomial whose weights are what remains of the targets, so the sources' totals come out
at their targets. Slot j of a source takes block perm(j mod n) of its n blocks, perm a keyed pseudorandom permutation,
and slots meet the blocks in a join by index. A source repeats only once all its blocks were taken as often.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rasterloom.llm.common import checkpointed, sub_batches, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1.0, 2.0, 3.0)
CAP = 3.0
BLOCK_WORDS = 64
SHARDS = 64
SEED = 20_240_229
#: Sources are mixture components, and their sizes are handled on the driver; beyond this many, mixing refuses.
MAX_SOURCES = 100_000
_BUCKETS = 4096
_RUN = 1 << 15


def water_fill(sizes: list[int], weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> list[float]:
    """Targets that share sum(sizes) by cycled weights; none is above cap times its size."""
    share = [weights[i % len(weights)] for i in range(len(sizes))]
    targets, active, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while active:
        total = math.fsum(share[i] for i in active)
        for i in active:
            targets[i] = left * share[i] / total
        above = {i for i in active if targets[i] > cap * sizes[i]}
        if not above:
            break
        for i in above:
            targets[i] = cap * sizes[i]
        left -= math.fsum(targets[i] for i in above)
        active -= above
    return targets


def shard_draws(slots: np.ndarray, shards: int = SHARDS, seed: int = SEED) -> np.ndarray:
    """(shards, sources) slot counts: multinomial draws over what is left of ``slots``; columns add up to ``slots``."""
    rng, left = np.random.default_rng(seed), slots.astype(np.int64).copy()
    out = np.zeros((shards, left.size), np.int64)
    for k in range(shards):
        need = -(-int(left.sum()) // (shards - k))
        while need:
            drawn = np.minimum(rng.multinomial(need, left / left.sum()), left)
            out[k] += drawn
            left -= drawn
            need -= int(drawn.sum())
    return out


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Keyed pseudorandom permutation of 0..size-1 at each index: a Feistel network that walks its cycle into range."""
    with np.errstate(over="ignore"):
        x, size, key = index.astype(np.uint64), size.astype(np.uint64), key.astype(np.uint64)
        bits = np.maximum(np.ceil(np.log2(np.maximum(size.astype(float), 2))), 2).astype(np.uint64) + np.uint64(1)
        half = bits // np.uint64(2)
        mask = (np.uint64(1) << half) - np.uint64(1)
        todo = np.ones(x.shape, bool)
        while todo.any():
            y, h, m, k = x[todo], half[todo], mask[todo], key[todo]
            a, b = y >> h, y & m
            for turn in range(6):
                z = (b + k + np.uint64(turn)) * np.uint64(0x9E3779B97F4A7C15)
                z = (z ^ (z >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                a, b = b, a ^ ((z ^ (z >> np.uint64(32))) & m)
            x[todo] = (a << h) | b
            todo = x >= size
        return x.astype(np.int64)


def _hash() -> Column:
    """A hash of a row's source and text."""
    source, text = F.col("source").cast("string"), F.col("text").cast("string")
    return F.xxhash64(source.isNull(), source, text.isNull(), text)


def _rows(docs: DataFrame) -> DataFrame:
    """A row for each document: doc_id, h (a hash of its source and text), source, size."""
    text = F.col("text").cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        _hash().alias("h"),
        F.col("source").cast("string").alias("source"),
        size.alias("size"),
    )


class Mix:
    """A mixture of ``docs`` (doc_id, text, source).

    Null and blank texts have size 0 and are never taken; a null source is a source of its own; repeated rows count and
    are taken each on its own; ties are ordered by doc_id and a hash of the text; other columns are ignored. An empty
    table gives empty results.
    """

    def __init__(self, docs: DataFrame, weights=WEIGHTS, cap=CAP, block_words=BLOCK_WORDS, shards=SHARDS, seed=SEED) -> None:
        self.docs, self.block, self.seed = docs, block_words, seed
        spark = docs.sparkSession
        self.spark = spark
        rows = checkpointed(_rows(docs))
        found = rows.groupBy("source").agg(F.sum("size").alias("n")).limit(MAX_SOURCES + 1).collect()
        if len(found) > MAX_SOURCES:
            raise ValueError(f"more than {MAX_SOURCES} sources")
        found.sort(key=lambda r: (r.source is None, r.source or ""))
        sizes = [int(r.n) for r in found]
        targets = water_fill(sizes, weights, cap)
        self.blocks = np.array([-(-n // block_words) for n in sizes], np.int64)
        self.slots = np.array([round(t * b / n) if n else 0 for t, b, n in zip(targets, self.blocks, sizes, strict=True)], np.int64)
        self.draws = shard_draws(self.slots, shards, seed) if self.slots.sum() else np.zeros((shards, len(sizes)), np.int64)
        named = [(r.source, i, sizes[i], targets[i]) for i, r in enumerate(found)]
        sources = spark.createDataFrame(named, "name string, src int, source_size long, target double")
        rows = rows.join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("name"))).drop("source", "name")
        self.rows = checkpointed(self._placed(rows))

    def _placed(self, rows: DataFrame) -> DataFrame:
        """Adds ``start``, the row's first word in its source; a prefix sum over buckets, so no source is in one task."""
        rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "h"), F.lit(_BUCKETS)).cast("int"))
        sums = rows.groupBy("src", "bucket").agg(F.sum("size").alias("n"))
        before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        bases = sums.select("src", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
        earlier = Window.partitionBy("src", "bucket").orderBy("doc_id", "h").rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("within", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
        rows = rows.join(bases, ["src", "bucket"])
        start = F.col("base") + F.col("within")
        return rows.select("doc_id", "h", "src", "size", "source_size", "target", start.alias("start"))

    def shard_slots(self) -> DataFrame:
        """(shard, src, j, block): each slot of each shard and the block that it takes."""
        base = np.cumsum(self.draws, axis=0) - self.draws
        shard, src = np.nonzero(self.draws)
        columns = {"shard": shard.astype(np.int32), "src": src.astype(np.int32), "base": base[shard, src], "n": self.draws[shard, src], "blocks": self.blocks[src]}
        schema = "shard int, src int, base long, n long, blocks long"
        rows = self.spark.createDataFrame(pa.table(columns), schema) if src.size else self.spark.createDataFrame([], schema)
        rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / _RUN))))
        rows = rows.repartition("shard", "src", "part")
        low, high = F.col("part") * _RUN, F.least(F.col("n"), (F.col("part") + 1) * _RUN) - 1
        rows = rows.withColumn("j", F.explode(F.sequence(F.col("base") + low, F.col("base") + high)))
        seed = self.seed

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                src, j, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("src", "j", "blocks"))
                key = (src.astype(np.uint64) + np.uint64(1)) * np.uint64(0x632BE59BD9B4E019 ^ seed)
                block = permuted(j % n, n, key)
                columns = [batch.column("shard"), batch.column("src"), batch.column("j"), pa.array(block)]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "src", "j", "block"])

        return rows.select("shard", "src", "j", "blocks").mapInArrow(place, "shard int, src int, j long, block long")

    def taken_segments(self) -> DataFrame:
        """(src, start, first, last, times): words first..last of the row at ``start`` that its blocks took ``times``."""
        b = self.block
        first, last = F.floor(F.col("start") / b), F.floor((F.col("start") + F.col("size") - 1) / b)
        parts = self.rows.where("size > 0").select("src", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
        parts = parts.select(
            "src",
            "block",
            "start",
            (F.greatest(F.col("block") * b, F.col("start")) - F.col("start")).alias("first"),
            (F.least((F.col("block") + 1) * b, F.col("start") + F.col("size")) - F.col("start") - 1).alias("last"),
        )
        times = self.shard_slots().groupBy("src", "block").agg(F.count("*").alias("times"))
        # The slots come of a small local table, which says nothing of their number: no broadcast.
        return parts.hint("merge").join(times, ["src", "block"]).select("src", "start", "first", "last", "times")

    def _with_taken(self, taken: DataFrame) -> DataFrame:
        at = F.when(F.col("size") > 0, F.col("start")).otherwise(-1 - F.pmod("h", F.lit(1 << 40)))
        taken = taken.withColumnRenamed("start", "at")
        return self.rows.withColumn("at", at).join(taken, ["src", "at"], "left")

    def summary(self) -> DataFrame:
        """(doc_id, size, source_size, target, taken), a row for each document."""
        taken = self.taken_segments().groupBy("src", "start")
        taken = taken.agg(F.sum((F.col("last") - F.col("first") + 1) * F.col("times")).alias("words"))
        rows = self._with_taken(taken)
        return rows.select("doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).alias("taken"))

    def documents(self) -> DataFrame:
        """The mixed documents, with the columns of ``docs``.

        A document taken r times over comes in r rows; row i has the words of the segments that were taken i times or
        more, in order, separate passages on lines of their own. A whole document keeps its text as it is. A column
        n_chars follows the text. Rows that share their id, source and text, null or not, are told apart by a number, by
        which each meets what was taken of one of them.
        """
        parts = self.taken_segments().groupBy("src", "start")
        parts = parts.agg(F.sort_array(F.collect_list(F.struct("first", "last", "times"))).alias("__parts"))
        rows = self._with_taken(parts).select(F.col("doc_id").alias("__rid"), F.col("h").alias("__rh"), "start", "__parts")
        keys = rows.groupBy("__rid", "__rh").agg(F.count("*").alias("__copies"), F.first("__parts", True).alias("__parts"))
        docs, schema = self.docs, self.docs.schema
        keyed = docs.select(F.struct("*").alias("__row"), F.col("doc_id").cast("long").alias("__id"), _hash().alias("__h"))
        same = F.col("__id").eqNullSafe(F.col("__rid")) & (F.col("__h") == F.col("__rh"))
        found = keyed.join(keys.where("__parts is not null"), same)
        single = found.where("__copies = 1").select("__row.*", "__parts")
        number = lambda *key: F.row_number().over(Window.partitionBy(*key).orderBy(key[-1]))
        left = found.where("__copies > 1").select("__row", "__id", "__h").withColumn("__n", number("__id", "__h"))
        right = rows.where("__parts is not null").withColumn("__rn", number("__rid", "__rh"))
        several = left.join(right, same & (F.col("__n") == F.col("__rn"))).select("__row.*", "__parts")
        return single.unionByName(several).mapInArrow(_cutter(schema), schema)


def _cutter(schema: T.StructType):
    names, word = schema.names, re.compile(WORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "text"):
            take, texts = [], []
            for row, (text, parts) in enumerate(zip(batch.column("text").to_pylist(), batch.column("__parts").to_pylist(), strict=True)):
                spans = None
                for turn in range(1, max(p["times"] for p in parts) + 1):
                    ranges: list[list[int]] = []
                    for p in parts:
                        if p["times"] >= turn:
                            if ranges and ranges[-1][1] + 1 == p["first"]:
                                ranges[-1][1] = p["last"]
                            else:
                                ranges.append([p["first"], p["last"]])
                    spans = spans or [m.span() for m in word.finditer(text)]
                    whole = ranges == [[0, len(spans) - 1]]
                    take.append(row)
                    texts.append(text if whole else "\n".join(text[spans[a][0] : spans[b][1]] for a, b in ranges))
            out = batch.take(pa.array(take, pa.int64()))
            columns = {n: out.column(n) for n in names}
            columns["text"] = pa.array(texts, pa.string())
            if "n_chars" in columns and pa.types.is_integer(columns["n_chars"].type):
                columns["n_chars"] = pa.array([len(t) for t in texts], columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    return run


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Mix(table(spark, sf_dir, "documents")).summary()
