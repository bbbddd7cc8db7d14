"""LM scoring by a hashed maximum-entropy model with a class-factored softmax.

A word's probability is that of its class, given the words before it, times that of the word in its class, given the same.
Both factors are softmaxes over hashed weights. The class sees the previous word, the classes of the three words before,
and as a skip feature the classes of the two words before the previous one; the word sees its class with the previous word
and, as a skip feature, with the word before that. Each class has its commonest words as outcomes of its own and an escape
for the others, which share it by their smoothed counts. The commonest words of all are classes by themselves; every other
word's class follows from its ending, so it is known without a vocabulary. Weights are trained by rounds of distributed
gradient updates: the training texts are dealt out over the rounds, in each of which every task runs over its texts in
minibatches from the shared weights, and the tasks' moves are averaged by tokens, in slices, before the next round.

Counts cover all training texts and go by 128-bit hashes of words. Words that are not frequent are counted and looked up in
a shuffle by word; only the bounded table of frequent words and the weights, of fixed size, are broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.llm.common import LOWER, checkpointed, remainder_column, sub_batches, table

#: Words with a count of their own in the broadcast table.
FREQUENT = 1 << 16
#: Outcomes of each softmax: classes, and the words of a class with the escape, outcome 0.
CLASSES = 32
#: Rows of hashed weights of each factor. Row 0 is the classes' constant; rows ROWS to ROWS + CLASSES those of the words.
ROWS = 1 << 14
#: Of the class: the previous word, the classes of three words, those of the two before the previous word. Of the word in
#: its class: the class with the previous word, and with the one before that.
CLASS_FEATURES, WORD_FEATURES = 3, 2
#: Rounds of training; a text is trained on in one of them.
ROUNDS = 4
RATE = 0.3
BATCH = 1 << 12
#: Slices in which tasks hand on their weights, and the tokens that a task trains on, so that these are few against its texts.
SLICES = 64
TASK_TOKENS = 2_000_000
#: Bound of a weight, so that no sum of a token's rows over- or underflows.
LIMIT = 10.0
#: Weights below this mark outcomes that a class lacks.
_LACKING = -5000.0
_SALTS = 8
_TOKENS = 1 << 12
#: Bytes of text that are tokenized at a time, for counting and for the model.
_BYTES, _MODEL_BYTES = 4 << 20, 2 << 20
#: Low bits of a word's first hash that its ending decides.
_ENDING = 10
_PUNCTUATION = b".,;:!?\"')(#*$%&|<>"
#: The hashes of the end of a text, which is word 0 of every batch.
END = (1, 0)


class _Endings(dict):
    """The low bits that an ending decides."""

    def __missing__(self, ending: bytes) -> int:
        found = self[ending] = xxhash.xxh32_intdigest(ending) >> 32 - _ENDING
        return found


_endings = _Endings()


class Tokens(NamedTuple):
    """A batch's distinct words by their two 64-bit hashes, the place there of each token, and where each text begins."""

    hashes: np.ndarray
    at: np.ndarray
    starts: np.ndarray


def word_hashes(words: list[bytes]) -> np.ndarray:
    """(word, 2) 64-bit hashes; the ending decides the low bits of the first one."""
    found = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<i8").reshape(-1, 2).copy()
    endings = [_endings[core[-3:] if (core := w.rstrip(_PUNCTUATION)) == w else core[-2:] + w[-1:]] for w in words]
    found[:, 0] = (found[:, 0] >> _ENDING << _ENDING) | np.array(endings, np.int64)
    return found


def tokens(texts: pa.Array) -> Tokens:
    """The words of all texts, A-Z lower-cased, each text with its end; a null text has its end alone."""
    split = pa.compute.ascii_split_whitespace(pa.compute.ascii_lower(texts.fill_null("")))
    words, cuts = split.flatten(), split.offsets.to_numpy() - split.offsets[0].as_py()
    some = pa.compute.greater(pa.compute.binary_length(words), 0)
    sizes = np.diff(np.concatenate(([0], np.cumsum(some.to_numpy(zero_copy_only=False))))[cuts])
    coded = words.filter(some).dictionary_encode()
    ends = np.cumsum(sizes + 1) - 1
    at = np.zeros(int(sizes.sum()) + len(sizes), np.int64)
    inside = np.ones(at.size, bool)
    inside[ends] = False
    at[inside] = coded.indices.to_numpy() + 1
    hashes = np.concatenate((np.array([END], np.int64), word_hashes(coded.dictionary.cast(pa.binary()).to_pylist())))
    return Tokens(hashes, at, ends - sizes)


class Counts(NamedTuple):
    """What all tasks share: totals, and the frequent words, sorted by hashes, with counts, classes and outcomes."""

    total: int
    distinct: int
    hashes: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    outcomes: np.ndarray
    alone: int

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Places of frequent words, of (word, 2) hashes; -1 for others."""
        out = np.full(len(hashes), -1)
        if len(self.hashes):
            at = np.searchsorted(self.hashes[:, 0], hashes[:, 0])
            left = np.arange(len(hashes))
            while left.size:  # words that share their first hash lie side by side
                left = left[at[left] < len(self.hashes)]
                left = left[self.hashes[at[left], 0] == hashes[left, 0]]
                same = self.hashes[at[left], 1] == hashes[left, 1]
                out[left[same]] = at[left[same]]
                left = left[~same]
                at[left] += 1
        return out

    def class_of(self, hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
        out = self.alone + (hashes[:, 0] & ((1 << _ENDING) - 1)) % (CLASSES - self.alone)
        often = places >= 0
        out[often] = self.classes[places[often]]
        return out


    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, classes and outcomes of words."""
        places = self.places(hashes)
        often = places >= 0
        outcomes = np.zeros(len(hashes), np.int64)
        outcomes[often] = self.outcomes[places[often]]
        return places, self.class_of(hashes, places), outcomes


def _training(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.where(remainder_column("doc_id", 5) != 1)


def word_counts(docs: DataFrame) -> DataFrame:
    """(h, g, c): exact counts of the training tokens, added up by batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "text", _BYTES):
            found = tokens(batch.column("text"))
            counts = np.bincount(found.at, minlength=len(found.hashes))
            columns = [found.hashes[:, 0], found.hashes[:, 1], counts.astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "g", "c"])

    counted = _training(docs).select("text").mapInArrow(run, "h long, g long, c long")
    return checkpointed(counted.groupBy("h", "g").agg(F.sum("c").alias("c")))


def shared_counts(counts: DataFrame) -> Counts:
    """Totals, and the words whose counts reach the least step, of sixteen to a doubling, that ``FREQUENT`` words reach.

    A histogram of steps finds it, so that no task hands the driver more than its own part of the table.
    """
    step = F.floor(F.log2("c") * 16).cast("int")
    bins = counts.groupBy(step.alias("step")).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()
    totals, cut, room = (sum(r.c for r in bins), sum(r.n for r in bins)), 1 << 30, FREQUENT
    for r in sorted(bins, key=lambda r: -r.step):
        if r.n > room:
            break
        cut, room = r.step, room - r.n
    top = counts.where(step >= cut).toPandas().sort_values(["c", "h", "g"], ascending=[False, True, True])
    hashes, c = top[["h", "g"]].to_numpy(np.int64), top["c"].to_numpy(np.int64)
    alone, left = 0, int(totals[0] or 0)
    while alone < min(len(c), CLASSES // 3) and c[alone] * (CLASSES - alone) >= left:
        left -= int(c[alone])
        alone += 1
    classes = alone + (hashes[:, 0] & ((1 << _ENDING) - 1)) % (CLASSES - alone)
    classes[:alone] = np.arange(alone)
    outcomes = np.zeros(len(c), np.int64)
    for k in range(alone, CLASSES):
        chosen = np.flatnonzero(classes == k)[: CLASSES - 1]
        outcomes[chosen] = np.arange(1, len(chosen) + 1)
    order = np.lexsort((hashes[:, 1], hashes[:, 0]))
    return Counts(int(totals[0] or 0), int(totals[1]), hashes[order], c[order], classes[order], outcomes[order], alone)


def _earlier(values: np.ndarray, starts: np.ndarray, steps: int, before: int) -> np.ndarray:
    """``values`` moved ``steps`` places on in each text; ``before`` where no value comes from the text itself."""
    out = np.empty_like(values)
    out[steps:] = values[: len(values) - steps]
    for k in range(steps):
        at = starts + k
        out[at[at < len(values)]] = before
    return out


def _mixed(values: np.ndarray, kind: int) -> np.ndarray:
    """Hashed rows 1 to ROWS - 1."""
    with np.errstate(over="ignore"):
        x = (values.view(np.uint64) + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        return ((x * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)) % np.uint64(ROWS - 1)).astype(np.int64) + 1


def class_rows(hashes: np.ndarray, classes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(token, ``CLASS_FEATURES``) rows of weights for the class; ``starts`` are the places of the texts' first tokens."""
    word = _earlier(hashes, starts, 1, END[0])
    a, b, c = (_earlier(classes, starts, k, CLASSES) for k in (1, 2, 3))
    pair = b * (CLASSES + 1) + c
    trio = (a + 1) * (CLASSES + 1) ** 2 + pair
    return np.stack([_mixed(x, kind) for kind, x in enumerate((word, trio, pair))], 1)


def word_rows(hashes: np.ndarray, classes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(token, ``WORD_FEATURES``) rows of weights for the word in its class."""
    with np.errstate(over="ignore"):
        own = (classes + 1) * np.int64(0x2545F4914F6CDD1D)
        found = [_mixed(_earlier(hashes, starts, steps, END[0]) ^ own, 8 + steps) for steps in (1, 2)]
    return np.stack([ROWS + CLASSES + x % (ROWS - CLASSES) for x in found], 1)


def log_softmax(weights: np.ndarray, base: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Logarithms of the outcomes' probabilities: the constant row ``base`` and the ``rows`` of each token are added up.

    Four rows at ``LIMIT`` at most keep the exponentials within single precision.
    """
    x = weights.take(base, axis=0)
    for column in rows.T:
        x += weights.take(column, axis=0)
    x -= np.log(np.exp(x) @ np.ones((x.shape[1], 1), x.dtype))
    return x


def update(weights: np.ndarray, squares: np.ndarray, base: np.ndarray, rows: np.ndarray, outcomes: np.ndarray, rate: float = RATE) -> None:
    """One step on a minibatch, each row of weights at its own rate (Adagrad over rows)."""
    if not len(rows):
        return
    slope = np.exp(log_softmax(weights, base, rows))
    slope[np.arange(len(outcomes)), outcomes] -= 1
    constants = np.arange(base.min(), base.max() + 1)
    flat = rows.ravel().astype(np.uint16)
    order = np.argsort(flat, kind="stable")
    ordered = flat[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    pairs = slope.take(order // rows.shape[1], axis=0).view(np.complex64)  # two numbers are added at a time
    summed = np.concatenate(((base == constants[:, None]).astype(np.float32) @ slope, np.add.reduceat(pairs, first, axis=0).view(np.float32)))
    touched = np.concatenate((constants, ordered[first].astype(np.int64)))
    squares[touched] += np.einsum("ij,ij->i", summed, summed) / summed.shape[1]
    summed *= (rate / np.sqrt(squares[touched]))[:, None]
    moved = weights.take(touched, axis=0) - summed
    weights[touched] = np.where(moved < _LACKING, moved, np.clip(moved, -LIMIT, LIMIT))


def trained(docs: DataFrame, counts: Counts, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (2 * ``ROWS``, ``CLASSES``), of the classes and of the words; fixed in size, however many texts there are.

    A round has the texts whose ids' hashes fall to it. Tasks also average the sums of squares that set the rates.
    """
    context = docs.sparkSession.sparkContext
    weights, squares = np.zeros((2 * ROWS, CLASSES), np.float32), np.ones(2 * ROWS, np.float32)
    used = np.zeros(CLASSES, np.int64)
    np.maximum.at(used, counts.classes, counts.outcomes)
    weights[ROWS : ROWS + CLASSES][np.arange(CLASSES) > used[:, None]] = 2 * _LACKING  # outcomes that a class lacks have no chance
    known = context.broadcast(counts)
    size = 2 * ROWS // SLICES
    tasks = counts.total // (rounds * TASK_TOKENS) + 1
    texts = _training(docs).withColumn("turn", F.pmod(F.xxhash64("doc_id"), F.lit(rounds)))
    for turn in range(rounds):
        start = context.broadcast((weights, squares))

        def run(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            before = start.value
            own, seen = [x.copy() for x in before], 0
            for batch in sub_batches(batches, "text", _MODEL_BYTES):
                words, at, starts = tokens(batch.column("text"))
                _, classes, outcomes = (x[at] for x in known.value.of(words))
                hashes = words[at, 0]
                by_class, by_word = class_rows(hashes, classes, starts), word_rows(hashes, classes, starts)
                inside = classes >= known.value.alone
                for a in range(0, len(at), BATCH):
                    part = slice(a, a + BATCH)
                    update(*own, np.zeros_like(classes[part]), by_class[part], classes[part])
                    chosen = np.flatnonzero(inside[part]) + a
                    update(*own, ROWS + classes[chosen], by_word[chosen], outcomes[chosen])
                seen += len(at)
            if seen:
                task = TaskContext.get().partitionId()
                moves = [((x - y) * seen).astype(np.float32) for x, y in zip(own, before, strict=True)]
                parts = [w.tobytes() + s.tobytes() for w, s in zip(*(np.split(m, SLICES) for m in moves), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(SLICES), pa.int32()), pa.array([task % _SALTS] * SLICES, pa.int32()), pa.array([seen] * SLICES, pa.int64()), pa.array(parts, pa.binary())],
                    ["slice", "salt", "seen", "delta"],
                )

        schema = "slice int, salt int, seen long, delta binary"
        moved = texts.where(F.col("turn") == turn).select("text").coalesce(tasks).mapInArrow(run, schema)
        for keys in (["slice", "salt"], ["slice"]):
            moved = moved.groupBy(*keys).applyInPandas(_added, schema)
        weights, squares = weights.copy(), squares.copy()
        for r in moved.collect():
            part = slice(r["slice"] * size, (r["slice"] + 1) * size)
            delta = np.frombuffer(r.delta, np.float32) / r.seen
            weights[part] += delta[:-size].reshape(size, CLASSES)
            squares[part] += delta[-size:]
        start.unpersist()
    return weights


def _added(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The sum of one slice's moves; rows come one batch at a time."""
    total, seen, first = None, 0, None
    for part in rows:
        for s, salt, n, delta in part[["slice", "salt", "seen", "delta"]].itertuples(index=False):
            first = first or (s, salt)
            move = np.frombuffer(delta, np.float32).astype(np.float64)
            total = move if total is None else total + move
            seen += n
    if total is not None:
        yield pd.DataFrame({"slice": [first[0]], "salt": [first[1]], "seen": [seen], "delta": [total.astype(np.float32).tobytes()]})


def class_totals(counts: DataFrame, known: Counts) -> tuple[np.ndarray, np.ndarray]:
    """Training tokens and distinct words of each class, without the words that are outcomes of their own."""
    shared = counts.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, CLASSES), np.int64)
        for batch in batches:
            h, g, c = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("h", "g", "c"))
            hashes = np.stack((h, g), 1)
            places = shared.value.places(hashes)
            own = shared.value.class_of(hashes, places)
            escaped = np.ones(len(h), bool)
            escaped[places >= 0] = shared.value.outcomes[places[places >= 0]] == 0
            sums[0] += np.bincount(own[escaped], c[escaped], CLASSES).astype(np.int64)
            sums[1] += np.bincount(own[escaped], minlength=CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(range(CLASSES), pa.int32()), pa.array(sums[0]), pa.array(sums[1])], ["k", "c", "v"])

    found = counts.mapInArrow(run, "k int, c long, v long").groupBy("k").agg(F.sum("c").alias("c"), F.sum("v").alias("v")).collect()
    out = np.zeros((2, CLASSES), np.int64)
    for r in found:
        out[:, r.k] = r.c, r.v
    return out[0], out[1]


class Model(NamedTuple):
    known: Counts
    weights: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    counts: DataFrame | None

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.known.total + 0.5 * (self.known.distinct + 1)))

    def norms(self) -> np.ndarray:
        """log10 of what a word's count plus a half is divided by for its share of its class's escape.

        Each class has one unseen word, so that the shares of all words add up to one.
        """
        return np.log10(self.class_tokens + 0.5 * (self.class_words + 1))

    def chosen(self, hashes: np.ndarray, classes: np.ndarray, outcomes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """log10 of the probability of each token's class and of its outcome there; a class of one word has no outcomes."""
        out = np.empty(len(hashes))
        by_class, by_word = class_rows(hashes, classes, starts), word_rows(hashes, classes, starts)
        for at in range(0, len(hashes), _TOKENS):
            part = np.arange(at, min(at + _TOKENS, len(hashes)))
            out[part] = log_softmax(self.weights, np.zeros_like(part), by_class[part])[np.arange(len(part)), classes[part]]
            part = part[classes[part] >= self.known.alone]
            out[part] += log_softmax(self.weights, ROWS + classes[part], by_word[part])[np.arange(len(part)), outcomes[part]]
        return out / math.log(10)


def fit(docs: DataFrame) -> Model:
    counts = word_counts(docs)
    known = shared_counts(counts)
    return Model(known, trained(docs, known), *class_totals(counts, known), counts)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs`` (doc_id, text).

    Scores are log10 probabilities of the text with its end: base_score by smoothed word counts, score by the model. Null
    texts count as empty and have their end alone; without training texts every word is unseen. Repeated rows each
    return; other columns are ignored; an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model._replace(counts=None))
    doc = "struct<doc_id:long,n_tokens:long,n_known:long,base:double,score:double>"
    schema = f"h long, g long, times long, class int, row long, doc {doc}"
    names = ["h", "g", "times", "class", "row", "doc"]
    kind = pa.struct([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, number = shared.value, TaskContext.get().partitionId() << 40
        norms = m.norms()
        for batch in sub_batches(batches, "text", _MODEL_BYTES):
            if not batch.num_rows:
                continue
            words, at, starts = tokens(batch.column("text"))
            word_places, word_classes, word_outcomes = m.known.of(words)
            n = len(starts)
            total = np.diff(np.append(starts, len(at)))
            owner = np.repeat(np.arange(n), total)
            places, classes, outcomes = word_places[at], word_classes[at], word_outcomes[at]
            score = np.bincount(owner, m.chosen(words[at, 0], classes, outcomes, starts), n)
            often = np.flatnonzero(places >= 0)
            seen = m.known.counts[places[often]] if often.size else np.empty(0, np.int64)
            base = np.bincount(owner[often], m.base(seen), n).astype(float)
            shares = np.where(outcomes[often] > 0, 0.0, np.log10(seen + 0.5) - norms[classes[often]])
            score += np.bincount(owner[often], shares, n)
            known = np.bincount(owner[often], minlength=n)
            row = number + np.arange(n)
            number += n
            spread = (row * -7046029254386353131).astype(np.int64)
            zero = np.zeros(n, np.int64)
            docs_ = pa.StructArray.from_arrays([batch.column("doc_id"), *map(pa.array, (total, known, base, score))], fields=list(kind))
            yield _rows(names, spread, zero, zero, zero.astype(np.int32), row, docs_)
            rare = np.flatnonzero(places < 0)
            if rare.size:
                key, times = np.unique(owner[rare] * len(words) + at[rare], return_counts=True)
                whose, word = np.divmod(key, len(words))
                yield _rows(names, words[word, 0], words[word, 1], times, word_classes[word].astype(np.int32), row[whose], pa.nulls(len(key), kind))

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
    known = model.known
    counts = model.counts.select(F.col("h").alias("__h"), F.col("g").alias("__g"), "c")
    word = F.col("times") > 0
    joined = rows.join(counts, (F.col("h") == F.col("__h")) & (F.col("g") == F.col("__g")) & word, "left")
    c = F.coalesce("c", F.lit(0)).cast("double")
    log = F.log10(c + 0.5)
    base = F.col("times") * (log - math.log10(known.total + 0.5 * (known.distinct + 1)))
    norm = F.element_at(F.array(*[F.lit(float(x)) for x in model.norms()]), F.col("class") + 1)
    found = joined.groupBy("row").agg(
        F.max("doc").alias("doc"),
        F.sum(F.when(word & (c > 0), F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.when(word, base).otherwise(0.0)).alias("base"),
        F.sum(F.when(word, F.col("times") * (log - norm)).otherwise(0.0)).alias("inside"),
    )
    return found.select(
        F.col("doc.doc_id").alias("doc_id"),
        (remainder_column("doc.doc_id", 5) == 1).alias("held_out"),
        F.col("doc.n_tokens").alias("n_tokens"),
        (F.col("doc.n_known") + F.col("known")).alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("doc.base") + F.col("base")).alias("base_score"),
        (F.col("doc.score") + F.col("inside")).alias("score"),
    )


def _rows(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)


def op8_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, fit(docs))
