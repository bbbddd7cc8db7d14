"""Language ID by cross-parsing entropy.

For each language, a suffix automaton of a labelled sample is built. A text is parsed from left to right into the longest
phrases that occur in the sample; the language that needs the fewest phrases per character wins, phrases being weighed
by the logarithm of the sample's length, the cost of pointing at one.

Whole texts are parsed, in lanes of fixed length, all lanes of a batch and all languages side by side: a step follows one
character in every lane by a lookup in one hash table of transitions, whose size goes by the samples' characters and not by
the number of different ones. A lane begins with a phrase of its own; the lane before it is then followed on until one of
its phrases begins where one of the lane's does, from where on both parse alike. So the phrases of a text are those of a
parse from its first character to its last, whatever the lanes' length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.llm.common import remainder, remainder_column, sub_batches, table

#: The bounded labelled sample: whole documents of so many characters, or the shortest of a language that has none, and
#: characters of a language.
SAMPLE_DOC_CHARS = 4000
SAMPLE_CHARS = 60_000
#: Characters of all languages together, which many languages share evenly, and what each has however many there are.
TOTAL_CHARS = 400_000
LEAST_CHARS = 800
LANE = 512
LANES = 4096
#: Bytes of text that are parsed at a time: they fill the lanes, and what is held of them stays small.
BYTES = 2 << 20
#: Lanes times languages that are parsed side by side.
CELLS = 2_000_000
#: Characters times languages whose phrases' beginnings are held at a time.
MARKS = 32_000_000
UNKNOWN = "und"


def normalised(text: str) -> str:
    """Lower-cased letters; each run of anything else is one space."""
    return " ".join("".join([c if c.isalpha() else " " for c in text.lower()]).split())


def _classes(codes: dict[str, int]) -> np.ndarray:
    """The code of each code point: that in ``codes``, 0 for letters of no sample, that of the space for all else."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    out = np.where(_letters, 0, codes[" "]).astype(np.int32)
    for c, i in codes.items():
        out[ord(c)] = i
    return out


_letters: np.ndarray | None = None


def suffix_automaton(codes: list[int]) -> tuple[int, np.ndarray]:
    """The number of states of the automaton of all substrings, and its (state, code, next state). State 0 is the start."""
    nexts, link, length, last = [{}], [-1], [0], 0
    for c in codes:
        new = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return len(nexts), np.array([(s, c, t) for s, found in enumerate(nexts) for c, t in found.items()], np.int64).reshape(-1, 3)


class Transitions:
    """A hash table from non-negative keys to values, with linear probing; keys are looked up many at a time."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        bits = max(4, int(3 * keys.size).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        #: Keys and values side by side, so that a lookup goes to one place in memory.
        self.slots = np.full((1 << bits, 2), -1, np.int64)
        at, left = self._home(keys), np.arange(keys.size)
        while left.size:
            chosen = left[self.slots[at[left], 0] < 0]
            self.slots[at[chosen]] = np.stack((keys[chosen], values[chosen]), 1)
            # Of keys that met in a place one has stayed.
            left = left[self.slots[at[left], 0] != keys[left]]
            at[left] = (at[left] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each of the ``keys`` (one dimension); -1 where there is none."""
        at = self._home(keys)
        there = self.slots.take(at, axis=0)
        other = there[:, 0] != keys
        out = there[:, 1].copy()
        left = np.flatnonzero(other)
        out[left] = -1
        left = left[there[left, 0] >= 0]
        while left.size:
            at[left] = (at[left] + 1) & self.mask
            there = self.slots.take(at[left], axis=0)
            same = there[:, 0] == keys[left]
            out[left[same]] = there[same, 1]
            left = left[~same & (there[:, 0] >= 0)]
        return out


def sample_chars(languages: int) -> int:
    """Characters of each language's sample."""
    return max(LEAST_CHARS, min(SAMPLE_CHARS, TOTAL_CHARS // max(1, languages)))


class Model:
    """Automata of several languages in one table; every character of a sample has a code."""

    def __init__(self, samples: dict[str, list[str]]) -> None:
        self.languages = sorted(samples)
        most = sample_chars(len(samples))
        joined = {k: "  ".join(normalised(t) for t in v)[:most] for k, v in samples.items()}
        self.codes = {c: i + 1 for i, c in enumerate(sorted({" ", *"".join(joined.values())}))}
        self.classes = len(self.codes) + 1
        edges, starts, states = [np.empty((0, 3), np.int64)], [], 0
        for k in self.languages:
            size, made = suffix_automaton([self.codes[c] for c in joined[k]])
            edges.append(made + np.array([states, 0, states]))
            starts.append(states)
            states += size
        found = np.concatenate(edges)
        #: Keys are state * classes + code, values the next state * classes.
        self.table = Transitions(found[:, 0] * self.classes + found[:, 1], found[:, 2] * self.classes)
        #: The last state has no transitions: it follows a character that no phrase begins with.
        self.dead = states * self.classes
        self.starts = np.array(starts, np.int64) * self.classes
        self.bits = np.array([np.log2(max(2, len(joined[k]))) for k in self.languages])
        self.lookup = _classes(self.codes)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "lookup"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.lookup = _classes(self.codes)

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The codes of all texts as by :func:`normalised`, with a space after each text, and the texts' lengths."""
        lowered = [t.lower() for t in texts]
        flat = np.frombuffer(" ".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes, space = self.lookup[flat], self.codes[" "]
        blank = codes == space
        keep = np.ones(codes.size, bool)
        keep[1:] = ~(blank[1:] & blank[:-1])
        ends = np.cumsum(np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1)
        if ends.size:
            keep[0] = not blank[0]
        kept = np.concatenate(([0], np.cumsum(keep)))[np.concatenate(([0], ends))]
        return codes[keep], np.diff(kept)

    def phrases(self, texts: list[str]) -> np.ndarray:
        """(text, language) phrases of each whole text; 0 without a letter."""
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        codes, sizes = self.encoded(texts)
        lanes = -(-sizes // LANE)
        if not lanes.sum():
            return out
        owner = np.repeat(np.arange(len(texts)), lanes)
        within = np.arange(owner.size) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        start = np.repeat(np.cumsum(sizes) - sizes, lanes) + within * LANE
        width = max(1, MARKS // codes.size)
        for at in range(0, out.shape[1], width):
            out[:, at : at + width] = self._counted(codes, sizes, owner, start, self.starts[at : at + width])
        return out

    def _counted(self, codes: np.ndarray, sizes: np.ndarray, owner: np.ndarray, start: np.ndarray, roots: np.ndarray) -> np.ndarray:
        """(text, root) phrases, from lanes that begin at ``start`` in the texts ``owner``."""
        begun = np.zeros((codes.size, roots.size), bool)
        ends = np.cumsum(sizes)
        size = np.minimum(LANE, ends[owner] - start)
        state = np.empty((owner.size, roots.size), np.int64)
        order = np.argsort(-size, kind="stable")
        most = max(1, min(LANES, CELLS // roots.size))
        for at in range(0, order.size, most):
            chosen = order[at : at + most]
            state[chosen] = self._parse(codes, start[chosen], size[chosen], roots, begun)
        joins = np.flatnonzero(owner[1:] == owner[:-1])
        more, meet = self._followed(codes, start[joins + 1], ends[owner[joins]], state[joins], roots, begun)
        out = np.empty((sizes.size, roots.size), np.int64)
        lane_of_text = np.searchsorted(owner, np.arange(sizes.size))
        for k in range(roots.size):
            seen = np.concatenate(([0], np.cumsum(begun[:, k])))
            out[:, k] = seen[ends] - seen[ends - sizes]
            change = more[:, k] - (seen[meet[:, k]] - seen[start[joins + 1]])
            at = owner[joins]
            lane = np.where(meet[:, k] < ends[at], lane_of_text[at] + (meet[:, k] - (ends - sizes)[at]) // LANE, owner.size)
            last = np.append(owner[1:] != owner[:-1], True)[joins + 1]
            plain = (lane == joins + 1) | (last & (lane == owner.size))
            odd = np.zeros(sizes.size, bool)
            odd[at[~plain]] = True
            out[:, k] += np.bincount(at[~odd[at]], change[~odd[at]], sizes.size).astype(np.int64)
            join_of = dict(zip(joins[odd[at]].tolist(), np.flatnonzero(odd[at]).tolist(), strict=True))
            for text in np.flatnonzero(odd):  # lanes that no phrase begins in are passed over
                join = join_of.get(int(lane_of_text[text]))
                while join is not None:
                    out[text, k] += change[join]
                    join = join_of.get(int(lane[join]))
        return out

    def _parse(self, codes: np.ndarray, start: np.ndarray, size: np.ndarray, roots: np.ndarray, begun: np.ndarray) -> np.ndarray:
        """The states behind the lanes' last characters; marks where phrases have begun. The longest lanes come first."""
        state = np.repeat(roots[None, :], start.size, 0)
        begun[start] = True
        ends = np.searchsorted(-size, -np.arange(LANE), "left")
        for step in range(int(size[0])):
            live = ends[step]
            code = codes[start[:live] + step].astype(np.int64)
            found = self.table.find((state[:live] + code[:, None]).ravel())
            missed = np.flatnonzero(found < 0)
            lane, language = np.divmod(missed, roots.size)
            begun[start[lane] + step, language] = True
            again = self.table.find(roots[language] + code[lane])
            found[missed] = np.where(again < 0, self.dead, again)
            state[:live] = found.reshape(live, -1)
        return state

    def _followed(self, codes: np.ndarray, at: np.ndarray, ends: np.ndarray, state: np.ndarray, roots: np.ndarray, begun: np.ndarray):
        """Parses on from ``at`` until a phrase begins where one is marked: (phrases begun before, the place), by row and root."""
        more, meet = np.zeros(state.shape, np.int64), np.repeat(ends[:, None], roots.size, 1)
        row, k = (x.ravel() for x in np.indices(state.shape))
        at, state = np.repeat(at, roots.size), state.ravel()
        while row.size:
            code = codes[at].astype(np.int64)
            found = self.table.find(state + code)
            missed = found < 0
            met = np.zeros(row.size, bool)
            met[missed] = begun[at[missed], k[missed]]
            meet[row[met], k[met]] = at[met]
            fresh = missed & ~met
            more[row[fresh], k[fresh]] += 1
            again = self.table.find(roots[k[fresh]] + code[fresh])
            found[fresh] = np.where(again < 0, self.dead, again)
            at = at + 1
            on = ~met & (at < ends[row])
            row, k, at, state = row[on], k[on], at[on], found[on]
        return more, meet

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Languages and scores; a score is 0 at a tie with the runner-up and nears 1 as the runner-up needs more bits."""
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        known = [t is not None and any(map(str.isalpha, t)) for t in texts]
        cost = self.phrases([t if k else "" for t, k in zip(texts, known, strict=True)]) * self.bits
        best = cost.argmin(1)
        least = np.take_along_axis(cost, best[:, None], 1)[:, 0]
        if len(self.languages) == 1:
            score = np.ones(len(texts))
        else:
            second = np.partition(cost, 1, axis=1)[:, 1]
            score = 1 - least / np.maximum(second, 1e-9)
        languages = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        return languages, [float(s) if k else 0.0 for s, k in zip(score, known, strict=True)]


def fit(docs: DataFrame) -> Model:
    """Learns from labelled documents of each language, spread over all by a hash of the id, up to :func:`sample_chars`.

    Documents longer than ``SAMPLE_DOC_CHARS`` are not drawn, but for the shortest of a language that has no others.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string"))
    rows = rows.where((remainder_column("doc_id", 3) != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.withColumn("size", F.length("text"))
    fits = F.col("size").between(1, SAMPLE_DOC_CHARS)
    stats = rows.groupBy("lang").agg(
        F.count_if(fits).alias("n"), F.sum(F.when(fits, F.col("size"))).alias("chars"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least")
    )
    stats = {r.lang: r for r in stats.collect()}
    if not stats:
        return Model({})
    most = sample_chars(len(stats))
    # Twice the documents that fill the sample on average.
    chance = {k: min(1.0, 2 * (most / r.chars + 1 / r.n)) if r.n else 0.0 for k, r in stats.items()}
    column = lambda found: F.create_map(*[F.lit(x) for pair in found.items() for x in pair])[F.col("lang")]
    at = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    drawn = fits & (at / (1 << 30) < column(chance))
    none = {k: r.least for k, r in stats.items() if not r.n and r.least}
    if none:
        drawn = drawn | (F.col("size") == column(none))
    sample = rows.where(drawn).select("lang", F.when(fits, at).otherwise(F.lit(0)).alias("at"), F.substring("text", 1, max(SAMPLE_CHARS, SAMPLE_DOC_CHARS)).alias("text"))
    found: dict[str, list] = {k: [] for k in stats}
    for r in sample.groupBy("lang", "at").agg(F.min("text").alias("text")).collect():
        found[r.lang].append((r["at"], r.text))
    return Model({k: [t for _, t in sorted(v)] for k, v in found.items()})


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of ``docs`` (doc_id, text).

    Null texts and texts without a letter are ``und`` with score 0. Every other text gets a language, ties going to the
    first by code point. Repeated rows each return, other columns are ignored, an empty table gives none. Whole texts
    are parsed, whatever their length.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "text", BYTES):
            ids = batch.column("doc_id").to_pylist()
            languages, scores = shared.value.predict(batch.column("text").to_pylist())
            held = pa.array([remainder(i, 3) == 1 for i in ids], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), held, pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text has a language, all columns kept, in one pass without a shuffle.

    Null texts and texts without a letter go, and all where nothing was learned; repeated rows and rows without an id are
    judged each by its text; an empty table stays one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "text", BYTES):
            languages, _ = shared.value.predict(batch.column("text").to_pylist())
            yield batch.filter(pa.array([x != UNKNOWN for x in languages], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predicted(docs, fit(docs))
