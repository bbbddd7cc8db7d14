"""SimHash near-dedup: pigeonhole blocks find every pair of fingerprints within a Hamming distance.

Of the blocks of a fingerprint, ``distance`` differing bits spoil at most ``distance``; the others are equal.
So each fingerprint goes into one bucket for every choice of ``blocks - distance`` blocks, and a close pair meets in one
of them at least. More fingerprints take more blocks, so that a key's bits keep up with their number; any number is exact. A bucket beyond ``chunk`` is dealt out as pairs of chunks, so that no task holds more than two chunks;
inside, pairs are verified by XOR and bit count, and only a spanning forest of the links leaves the task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.llm.common import LOWER, checkpointed, hot_join, sub_batches, table
from rasterloom.llm.components import connected_components

WORDS = 4
DISTANCE = 4
SEED = 42
#: Chance meetings that a fingerprint may have in all its buckets before a wider key is chosen, and the most blocks.
MEETINGS = 256
MOST_BLOCKS = 9
CHUNK = 2048
_SLICE = 1 << 16


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Signed 64-bit SimHash of the word shingles; null and wordless texts have 0."""
    tokens = [] if text is None else text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not tokens:
        return 0
    digest = xxhash.xxh64_digest
    if len(tokens) <= words:
        return int.from_bytes(digest(b" ".join(tokens), SEED), "big", signed=True)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(tokens) - words + 1].tolist()
    ends = ends[words - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), _SLICE):
        spans = zip(starts[at : at + _SLICE], ends[at : at + _SLICE], strict=True)
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in spans])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64).sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big", signed=True)


def _hashes() -> dict[str, Column]:
    """Two hashes of a text, which with its doc_id stand for a row."""
    text = F.col("text").cast("string")
    return {"__a": F.xxhash64(text), "__b": F.xxhash64(F.lit(1), text)}


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, fp long, __a long, __b long), a row for each row of ``docs``; the last two are hashes of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "text"):
            fps = pa.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], pa.int64())
            kept = {n: batch.column(n) for n in ("doc_id", "__a", "__b")}
            yield pa.RecordBatch.from_arrays([*kept.values(), fps], [*kept, "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *(c.alias(n) for n, c in _hashes().items()))
    return rows.mapInArrow(run, "doc_id long, __a long, __b long, fp long")


def forest(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, first member) that connect the same fingerprints as all pairs within ``distance`` do."""
    left, members, roots = fps, [], []
    while left.size > 1:
        root, left = left[0], left[1:]
        queue = [root]
        while queue and left.size:
            near = np.bitwise_count(left ^ queue.pop()) <= distance
            if near.any():
                found = left[near]
                left = left[~near]
                members.append(found)
                roots.append(np.full(found.size, root))
                queue.extend(found)
    if not members:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(members), np.concatenate(roots)


def blocks_for(count: int, distance: int = DISTANCE) -> int:
    """The least number of blocks with which ``count`` fingerprints meet few others by chance.

    There are C(blocks, distance) buckets for each, of count / 2^(64 (blocks - distance) / blocks) others on average.
    """
    for blocks in range(distance + 2, MOST_BLOCKS):
        if comb(blocks, distance) * count / 2 ** (64 * (blocks - distance) / blocks) <= MEETINGS:
            return blocks
    return max(MOST_BLOCKS, distance + 2)


def links(distinct: DataFrame, distance: int = DISTANCE, blocks: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """Edges (u, v) that connect all of ``distinct`` (fp long) within ``distance`` bits; no pair beyond is an edge's cause.

    Any number of ``blocks`` finds the same links; by default it goes by the number of fingerprints.
    """
    blocks = blocks_for(distinct.count(), distance) if blocks is None else blocks
    if not 0 <= distance < blocks:
        raise ValueError("blocks must exceed distance")
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        key = F.lit(number).cast("long")
        for b in chosen:
            width = cuts[b + 1] - cuts[b]
            part = F.shiftrightunsigned("fp", cuts[b]).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
            key = F.shiftleft(key, width).bitwiseOR(part) if (blocks - distance) * width < 56 else F.xxhash64(key, part)
        keys.append(F.struct(F.lit(number).alias("n"), key.alias("k")))
    keyed = distinct.select("fp", F.explode(F.array(*keys)).alias("b")).select("fp", "b.n", "b.k")
    shared = keyed.groupBy("n", "k").agg(F.count("*").alias("size")).where("size > 1")
    shared = shared.select("n", "k", F.ceil(F.col("size") / chunk).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks").cast("long")).cast("int")
    dealt = (
        keyed.join(shared, ["n", "k"])
        .select("fp", "n", "k", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
        .select("fp", F.xxhash64("n", "k", F.least("own", "other"), F.greatest("own", "other")).alias("cell"))
        .repartition("cell")
        .sortWithinPartitions("cell")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64), np.empty(0, np.int64)]

        def linked(cells: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            at = np.flatnonzero(np.diff(cells)) + 1
            pairs = [forest(x, distance) for x in np.split(fps, at) if x.size > 1]
            u, v = (np.concatenate([p[i] for p in pairs] or [np.empty(0, np.int64)]) for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for batch in batches:
            cells, fps = (
                np.concatenate((held[i], batch.column(c).to_numpy(zero_copy_only=False)))
                for i, c in enumerate(("cell", "fp"))
            )
            if not cells.size:
                continue
            last = int(np.searchsorted(cells, cells[-1]))
            held = [cells[last:], fps[last:]]
            yield linked(cells[:last], fps[:last])
        yield linked(*held)

    return dealt.mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, words: int = WORDS, blocks: int | None = None) -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``docs``.

    Rows link if their fingerprints differ in at most ``distance`` bits; component_id is the smallest doc_id that links
    reach. Null and wordless texts have fingerprint 0 and link like any other; repeated rows each return; rows with a
    null doc_id take part, and their component_id is null only if no reached row has an id; an empty table returns none.
    """
    return _grouped(docs, distance, words, blocks).select("doc_id", "fp", "component_id")


def _grouped(docs: DataFrame, distance: int, words: int = WORDS, blocks: int | None = None) -> DataFrame:
    """:func:`near_duplicates` with the hashes of each row's text, and its component, which is null in no row."""
    rows = checkpointed(fingerprints(docs, words))
    least = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    groups = connected_components(links(least.select("fp"), distance, blocks))
    labelled = least.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", "n", F.coalesce("component", "fp").alias("component")
    )
    ids = labelled.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("fps"))
    classes = checkpointed(hot_join(labelled, ids, "component", "fps", least.count()))
    return hot_join(rows, classes, "fp", "n", rows.count()).select("doc_id", "fp", "__a", "__b", "component", "component_id")


def deduplicated(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """One row of ``docs`` for each component, all columns kept: that of the smallest doc_id, fingerprint and text hash.

    A row without an id stays only if nothing it links with has one; texts that do not link stay whatever their ids. Of
    rows with the same doc_id and the same text one is kept.
    """
    found = _grouped(docs, distance).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = found.groupBy("component", F.col("doc_id").alias("__kept")).agg(F.min(F.struct("fp", "__a", "__b")).alias("__row"))
    kept = kept.select("__kept", F.col("__row.__a").alias("__c"), F.col("__row.__b").alias("__d"))
    keyed = docs.withColumns(_hashes() | {"__id": F.col("doc_id").cast("long")})
    same = F.col("__id").eqNullSafe(F.col("__kept")) & (F.col("__a") == F.col("__c")) & (F.col("__b") == F.col("__d"))
    return keyed.join(kept, same, "left_semi").dropDuplicates(["__id", "__a", "__b"]).drop("__id", "__a", "__b")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
