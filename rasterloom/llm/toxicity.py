"""Toxicity by noisy-channel deobfuscation.

A word with digits or symbols among its letters, with drawn-out letters, or spelt letter by letter is taken for the
output of a noisy channel. Its lattice gives each character the letters it may stand for, lets separators vanish or end
a word, and lets a repeated letter vanish; a Viterbi search finds the reading that a character trigram model and the
channel together make likeliest. The restored words are then scored by the odds that labelled texts give them, or, where
a word is too rare, its stem.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.llm.common import checkpointed, remainder, remainder_column, sub_batches, table

#: A word or stem is learned from so many toxic texts on, where the lower confidence bound of its odds stands out and chance
#: explains no more than this share of what is learned.
LEAST_TEXTS = 3
LEAST_ODDS = 2.0
CONFIDENCE = 2.0
FALSE_SHARE = 0.05
#: Letters of the stems that stand for words too rare to be learned; a stem is written with an asterisk.
STEMS = (4, 5, 6)
#: Bits of the filter that keeps texts without a label from being read; where it fills up, more texts are read.
_BITS = 1 << 25
#: Steps of the histogram of significance, to the unit of minus the logarithm.
_STEPS = 8
#: Stems or trigrams that a task holds before it hands on their counts.
_HELD = 400_000
#: Words that a task holds to unite near copies before it hands them on.
_UNITED = 100_000
PRIOR_WEIGHT = 3.0
THRESHOLD = 0.7
CACHE = 400_000
#: Fixed table: the letters that a character may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
SEPARATORS = " ._*-~'/"
_EDGE = ".,;:?\"'()[]{}<>*&%#-_~`^=/\\"
_NOISE = re.compile(r"[0-9@$!|+(€£]|(.)\1\1|[._*~/-]")
_SPELT = re.compile(r"(?<!\S)(?:[^\W_]|[@$!|+(€£])(?:[ ._*~-]{1,2}(?:[^\W_]|[@$!|+(€£])){3,}(?!\S)")
_PARTS = re.compile(r"[._*~/-]+")


def trigrams(words: Iterable[tuple[str, int]]) -> Counter:
    """Counts of the character trigrams of ``words`` (word, n), with "^" before and " " after a word."""
    out: Counter = Counter()
    for word, n in words:
        padded = f"^^{word} "
        for i in range(2, len(padded)):
            out[padded[i - 2 : i + 1]] += n
    return out


class CharacterModel:
    """Interpolated character trigrams of lower-cased words, of ``words`` and those ``seen``, which are counted already."""

    def __init__(self, words: dict[str, int], seen: dict[str, int] | None = None) -> None:
        self.counts: list[Counter] = [Counter(), Counter(), Counter()]
        for grams in (seen or {}, trigrams(words.items())):
            for gram, n in grams.items():
                for order in range(3):
                    self.counts[order][gram[2 - order :]] += n
        self.totals: list[Counter] = [Counter(), Counter(), Counter()]
        for order in range(3):
            for gram, n in self.counts[order].items():
                self.totals[order][gram[:-1]] += n
        self.size = len(self.counts[0]) + 1
        self.known: dict[str, float] = {}

    def cost(self, context: str, letter: str) -> float:
        """Minus the logarithm of the probability of ``letter`` after the two characters of ``context``."""
        key = context + letter
        found = self.known.get(key)
        if found is None:
            p = 1 / self.size
            for order in range(3):
                seen = self.totals[order][key[2 - order : 2]]
                p = (self.counts[order][key[2 - order :]] + 4 * p) / (seen + 4)
            found = self.known[key] = -math.log(p)
        return found


#: Costs of the channel's steps: a symbol for a letter, a letter dropped as drawn out (dearer from a mere double), a
#: separator dropped or kept.
_SYMBOL, _SAME, _DRAWN, _DOUBLE, _GLUE, _BREAK = 0.7, 0.0, 0.4, 2.5, 0.2, 2.0


def decode(text: str, model: CharacterModel) -> str:
    """The likeliest words behind ``text``, by a Viterbi search whose states are the last two characters.

    Readings are chains of letters that share their beginnings, so that time and memory are linear in the length.
    """
    states: dict[tuple[str, str], tuple[float, tuple | None]] = {("^^", ""): (0.0, None)}
    for i, c in enumerate(text):
        following: dict[tuple[str, str], tuple[float, tuple | None]] = {}

        def reach(state: tuple[str, str], cost: float, out: tuple | None) -> None:
            if state not in following or cost < following[state][0]:
                following[state] = (cost, out)  # noqa: B023

        for (context, last), (cost, out) in states.items():
            if c in SEPARATORS:
                reach((context, ""), cost + _GLUE, out)
                if context != "^^":
                    reach(("^^", ""), cost + _BREAK + model.cost(context, " "), (out, " "))
                continue
            if c == last:
                long = text[i - 2 : i] == c + c or text[i + 1 : i + 2] == c
                reach((context, last), cost + (_DRAWN if long else _DOUBLE), out)
            letters = [(c, _SAME)] if c.isalpha() else [(x, _SYMBOL) for x in LEET.get(c, "")] or [("", _SYMBOL)]
            for letter, extra in letters:
                if not letter:
                    reach((context, ""), cost + 6.0, out)
                    continue
                reach((context[1] + letter, c), cost + extra + model.cost(context, letter), (out, letter))
        states = following
    ends = [(cost + model.cost(context, " "), out) for (context, _), (cost, out) in states.items()]
    least = min(cost for cost, _ in ends)
    return min(_unrolled(out) for cost, out in ends if cost == least)


def _unrolled(chain: tuple | None) -> str:
    letters = []
    while chain:
        chain, letter = chain
        letters.append(letter)
    return "".join(reversed(letters))


class Model:
    """Word odds, and the character model that restores words."""

    def __init__(self, odds: dict[str, float], prior: float, characters: CharacterModel) -> None:
        self.odds, self.prior, self.characters = odds, prior, characters
        self.words: dict[str, tuple[str, ...]] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"words": {}}

    def restored(self, word: str) -> tuple[str, ...]:
        """The scored words and stems behind a white-space free lower-cased string."""
        found = self.words.get(word)
        if found is None:
            core = word.strip(_EDGE)
            readings = {core}
            if core and _NOISE.search(core) and any(map(str.isalpha, core)):
                parts = _PARTS.split(core)
                spelt = sum(len(p) == 1 for p in parts) > len(parts) // 2
                readings.update(parts)
                whole = core.rstrip("!|+($")
                for text in {whole, core} if spelt or len(parts) == 1 else {*parts, core}:
                    if text:
                        readings.update(decode(text, self.characters).split())
            found = tuple(sorted({f for r in readings if (f := self.feature(r))}))
            if len(self.words) >= CACHE:
                self.words.clear()
            if len(word) <= 64:
                self.words[word] = found
        return found

    def feature(self, word: str) -> str | None:
        """What is scored for a word: itself, or else the longest of its stems that was learned."""
        if word in self.odds:
            return word
        return next((f for k in reversed(STEMS) if len(word) > k and (f := word[:k] + "*") in self.odds), None)

    def score(self, text: str | None) -> float:
        hits: set[str] = set()
        if text:
            lower = text.lower()
            for word in set(lower.split()):
                hits.update(self.restored(word))
            for m in _SPELT.finditer(lower):
                hits.update(f for w in decode(m[0], self.characters).split() if (f := self.feature(w)))
        return 1 / (1 + math.exp(-min(max(self.prior + sum(self.odds[w] for w in sorted(hits)), -30), 30)))


def _words(text: str) -> list[str]:
    return sorted({c for w in set(text.lower().split()) if (c := w.strip(_EDGE + "!|")) and c.isalpha()})


def least_share(hits: Column, n: Column, z: float = CONFIDENCE) -> Column:
    """The lower end of the Wilson interval of ``hits`` in ``n``, at ``z`` standard errors."""
    p = hits / n
    return (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def surprise(bad: Column, n: Column, base: float) -> Column:
    """Minus the logarithm of Chernoff's bound on the chance of ``bad`` or more in ``n`` at a rate of ``base``."""
    p = bad / n
    rest = F.when(p < 1, (1 - p) * F.log((1 - p) / (1 - base))).otherwise(0.0)
    return F.when(p > base, n * (p * F.log(p / base) + rest)).otherwise(0.0)


def least_step(bins: dict[int, int], share: float = FALSE_SHARE) -> int:
    """The least step of surprise from which chance explains at most ``share`` of the features there (Benjamini, Hochberg, 1995).

    ``bins`` counts the features tested at each step, of which there are ``_STEPS`` to a unit.
    """
    total, kept, least = sum(bins.values()), 0, 1 << 30
    for step in sorted(bins, reverse=True):
        kept += bins[step]
        if total * math.exp(-step / _STEPS) <= share * kept:
            least = step
    return least


def _united(texts: DataFrame) -> DataFrame:
    """``texts`` (label, copy, words) to one row for each label and copy with the words of all its texts, put together in tasks before the shuffle too."""

    def united(last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple[int, int], set[str]] = {}
            size = 0

            def flushed() -> pa.RecordBatch:
                labels, copies = ([k[i] for k in held] for i in (0, 1))
                words = [" ".join(sorted(w)) for w in held.values()]
                held.clear()
                return pa.RecordBatch.from_arrays(
                    [pa.array(labels, pa.int32()), pa.array(copies, pa.int64()), pa.array(words, pa.string())],
                    ["label", "copy", "words"],
                )

            for batch in batches:
                for label, copy, words in zip(*(batch.column(c).to_pylist() for c in ("label", "copy", "words")), strict=True):
                    if size > _UNITED and not (last and (label, copy) in held):  # in the last step a new key ends those before
                        yield flushed()
                        size = 0
                    mine = held.setdefault((label, copy), set())
                    size -= len(mine)
                    mine.update(words.split())
                    size += len(mine) + 1
            yield flushed()

        return run

    schema = "label int, copy long, words string"
    dealt = texts.mapInArrow(united(False), schema).repartition("label", "copy").sortWithinPartitions("label", "copy")
    return dealt.mapInArrow(united(True), schema)


def _stem_counts(texts: DataFrame, known: set[str]) -> DataFrame:
    """(word, bad, good): texts (label, words, joined by spaces) with each stem of a word that is not ``known``; added up before the shuffle."""
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def flushed() -> pa.RecordBatch:
            stems = list(counts[0].keys() | counts[1].keys())
            columns = [pa.array(stems, pa.string()), *(pa.array([c[s] for s in stems], pa.int64()) for c in counts)]
            for c in counts:
                c.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "bad", "good"])

        for batch in batches:
            for label, words in zip(batch.column("label").to_pylist(), batch.column("words").to_pylist(), strict=True):
                rare = [w for w in words.split() if w not in shared.value]
                counts[label <= 0].update({w[:k] + "*" for k in STEMS for w in rare if len(w) > k})
                if sum(map(len, counts)) > _HELD:
                    yield flushed()
        yield flushed()

    found = texts.select("label", "words").mapInArrow(run, "word string, bad long, good long")
    return found.groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def _learned(counted: DataFrame, base: float, prior: float) -> list:
    """Rows (word, odds) of what stands out in ``counted`` (word, bad, good)."""
    texts = F.col("bad") + F.col("good")
    odds = F.log((F.col("bad") + PRIOR_WEIGHT * base) / (F.col("good") + PRIOR_WEIGHT * (1 - base))) - prior
    step = F.floor(surprise(F.col("bad"), texts, base) * _STEPS).cast("int")
    tested = counted.where((F.col("word") != "") & (texts >= LEAST_TEXTS)).withColumns({"odds": odds, "step": step})
    least = least_step({r.step: r["count"] for r in tested.groupBy("step").count().collect()})
    share = least_share(F.col("bad"), texts)
    clear = F.log(share / (1 - share)) - prior >= LEAST_ODDS
    kept = tested.where((F.col("bad") >= LEAST_TEXTS) & (F.col("step") >= least) & clear)
    return kept.select("word", "odds").collect()


def _characters(counted: DataFrame, learned: list[str]) -> CharacterModel:
    """The character model of all words of ``counted`` (word, bad, good) and of those ``learned``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, ["gram", "n"])

        for batch in batches:
            words, ns = (batch.column(c).to_pylist() for c in ("word", "n"))
            for i in range(0, len(words), 1000):
                counts.update(trigrams(zip(words[i : i + 1000], ns[i : i + 1000], strict=True)))
                if len(counts) > _HELD:
                    yield flushed()
        yield flushed()

    words = counted.where("word != ''").select("word", (F.col("bad") + F.col("good")).alias("n"))
    seen = words.mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    total = words.agg(F.sum("n")).first()[0] or 0
    boost = max(1, total // max(1, len(learned)))  # noise hides words of the lexicon more often than others
    return CharacterModel(dict.fromkeys(learned, boost), {r.gram: r.n for r in seen.collect()})


def _maybe_in(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id may be one of ``ids``: all that are, and few others.

    Ids set bits by a hash, in a table of ``_BITS`` bits, so what is broadcast does not grow with them.
    """
    at = F.pmod(F.xxhash64("doc_id"), F.lit(_BITS))
    bits = ids.groupBy(F.bitmap_bucket_number(at).alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("__bits"))
    marked = docs.withColumns({"__bucket": F.bitmap_bucket_number(at), "__at": F.bitmap_bit_position(at)}).join(F.broadcast(bits), "__bucket")
    byte = F.conv(F.hex(F.expr("substring(__bits, cast(__at div 8 as int) + 1, 1)")), 16, 10).cast("int").alias("__byte")
    return marked.select(*docs.columns, "__at", byte).where("shiftright(__byte, cast(__at % 8 as int)) & 1 = 1").select(*docs.columns)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """Learns from all labelled texts that are not held out.

    A word counts once for each label in near copies, which share the smallest hash of their five-word shingles: it is
    enough that one of them has it. Texts meet their labels by a shuffle of their distinct words.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    rows = rows.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    rows = checkpointed(rows.where(remainder_column("doc_id", 3) != 1))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = _maybe_in(texts.where("doc_id is not null and text is not null"), rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "text"):
            keys, words = [], []
            for text in batch.column("text").to_pylist():
                parts = text.lower().split()
                shingles = [" ".join(parts[i : i + 5]) for i in range(max(1, len(parts) - 4))]
                keys.append(xxhash.xxh64_intdigest(min(shingles, key=xxhash.xxh64_intdigest)) >> 1)
                words.append(" ".join(_words(text)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(keys, pa.int64()), pa.array(words, pa.string())],
                ["doc_id", "copy", "words"],
            )

    found = texts.mapInArrow(run, "doc_id long, copy long, words string").join(rows, "doc_id")
    found = checkpointed(_united(found.select("label", "copy", "words")).select("label", "words"))
    each = F.array_distinct(F.split(F.concat("words", F.lit(" ")), " "))  # and the empty word, which stands for the text
    words = found.select("label", F.explode(each).alias("word"))
    counted = words.groupBy("word").agg(F.count_if(F.col("label") > 0).alias("bad"), F.count_if(F.col("label") <= 0).alias("good"))
    counted = checkpointed(counted)
    total = counted.where("word = ''").first()
    bad, good = (total.bad, total.good) if total else (0, 0)
    base = (bad + 1) / (bad + good + 2)
    prior = math.log(base / (1 - base))
    kept = _learned(counted, base, prior)
    kept += _learned(checkpointed(_stem_counts(found, {r.word for r in kept})), base, prior)
    return Model({r.word: r.odds for r in kept}, prior, _characters(counted, [r.word.removesuffix("*") for r in kept]))


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs`` (doc_id, text).

    Null and empty texts score as texts without a known word; repeated rows each return; other columns are ignored; an
    empty table gives none. Without labels every text scores alike. Whole texts are read, in one pass without a shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.score
        for batch in sub_batches(batches, "text"):
            scores = [score(t) for t in batch.column("text").to_pylist()]
            held = pa.array([remainder(i, 3) == 1 for i in batch.column("doc_id").to_pylist()], pa.bool_())
            found = pa.array([int(s >= threshold) for s in scores], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), held, pa.array(scores, pa.float64()), found],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, fit(docs, table(spark, sf_dir, "labels")))
