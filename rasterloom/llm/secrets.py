"""Secret scans: fixed patterns, and a guess-cost model for values in a credential's context.

The model finds the cheapest way to guess a value: a dynamic program splits it into common words, dates, repeats,
keyboard walks and sequences, and brute-forced characters, each with its number of guesses (Wheeler, 2016). A value that
takes ``MIN_GUESSES`` decimal digits of guesses or more is taken for a secret rather than for prose.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rasterloom.llm import packing
from rasterloom.llm.common import sub_batches, table

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: A credential's name, a separator and the place of a value, which goes on to the closing quote or to white space.
CONTEXT = re.compile(
    r"""(?<![a-z])(pass(?:word|wd|phrase|code)|pwd|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key|credentials?)"""
    r"""["']?\x20*(?:is|was|[:=]>?)\x20*(["']?)(?=[!-~]{6})""",
    re.I | re.A,
)
RUN = re.compile(r"[!-~]+")
CONTEXT_HINTS = ("pass", "pwd", "secret", "token", "key", "credential")
MIN_GUESSES = 9.0
KINDS = ("assign", "access", "hex", "guess")
MASK = "[SECRET]"
#: Fixed list of common password words, the commonest first.
WORDS = (
    "password pass admin welcome login letmein qwerty secret monkey dragon master test user root guest default changeme "
    "hello love sunshine princess football baseball shadow superman batman michael summer winter spring autumn "
    "computer internet server access private public token key money access temp demo example sample value none null "
    "true false string your here the and for with that this from"
).split()
#: Keyboard rows.
ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz")
LEET = str.maketrans("013457@$!", "oieastasi")


#: The longest repeated unit, and the longest value whose cost is remembered.
UNITS, REMEMBERED = 64, 128
LONGEST_WORD = 24


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def _walks() -> dict[str, str]:
    """Pairs of neighbouring keys."""
    return {a + b for row in ROWS for x in (row, row[::-1]) for a, b in zip(x, x[1:])}


WALKS = _walks()
DATE = re.compile(r"(?:19|20)\d\d|\d{1,2}[/.-]\d{1,2}[/.-](?:19|20)?\d\d|(?:19|20)\d\d[/.-]?\d{2}[/.-]?\d{2}|\d{2}\d{2}(?:19|20)\d\d")


def _alphabet(text: str) -> int:
    kinds = ((str.islower, 26), (str.isupper, 26), (str.isdigit, 10))
    size = sum(n for test, n in kinds if any(map(test, text)))
    return size + (33 if not text.isalnum() else 0)


@lru_cache(maxsize=1)
def dictionary() -> dict[str, int]:
    """Ranks of words: ``WORDS``, then the whole words of the tokenizer's vocabulary, which come by their frequency in text.

    Prose in a credential's context consists of such words; random letters do not.
    """
    vocabulary = Tokenizer.from_file(packing.default_tokenizer()).get_vocab()
    ended = (w.removesuffix("</w>") for w in sorted(vocabulary, key=vocabulary.get) if w.endswith("</w>"))
    words = [w for w in ended if w.isascii() and w.isalpha() and w.islower() and 3 <= len(w) <= LONGEST_WORD]
    return {w: i + 1 for i, w in reversed(list(enumerate([*WORDS, *words])))}


def guess_cost(value: str, enough: float = math.inf) -> float:
    """Decimal digits of the guesses that the cheapest segmentation of ``value`` needs; 0 for an empty value.

    From ``enough`` on, a long value's cost may be given as a lower bound that is no less than ``enough``.
    """
    return _remembered(value) if len(value) <= REMEMBERED else _cheapest(value, enough)


@lru_cache(maxsize=100_000)
def _remembered(value: str) -> float:
    return _cheapest(value, math.inf)


def _cheapest(value: str, enough: float) -> float:
    """The dynamic program. Runs of repeats and of neighbouring keys are carried along: each character takes the same work."""
    n, lower = len(value), value.lower()
    plain = lower.translate(LEET)
    ranks = dictionary()
    brute = math.log10(max(_alphabet(value), 2))
    best = [0.0] + [math.inf] * n
    repeated = [0] * (UNITS + 1)
    walk, starts = 0, []
    for end in range(1, n + 1):
        best[end] = best[end - 1] + brute
        for start in range(max(0, end - LONGEST_WORD), end - 2):
            rank = ranks.get(lower[start:end]) or ranks.get(plain[start:end])
            if rank:
                change = 0.0 if value[start:end] == lower[start:end] == plain[start:end] else math.log10(4)
                best[end] = min(best[end], best[start] + math.log10(rank + 1) + change + 0.3)
        for start in range(max(0, end - 10), end - 3):
            if DATE.fullmatch(value, start, end):
                best[end] = min(best[end], best[start] + math.log10(365 * 120))
        if end == 1 or lower[end - 2 : end] not in WALKS:
            walk, starts = end - 1, []
        start = end - 3
        if start >= walk and all(best[start] < best[s] + math.log10((3 + start - s) / 3) for s in starts):
            starts.append(start)  # the others begin no cheaper walk, however far it goes
        for start in starts:
            best[end] = min(best[end], best[start] + math.log10(47 * 4 * (end - start)))
        for unit in range(1, min(UNITS, end - 1) + 1):
            repeated[unit] = repeated[unit] + 1 if value[end - 1] == value[end - 1 - unit] else 0
            times = repeated[unit] // unit + 1
            if times >= (3 if unit == 1 else 2):
                best[end] = min(best[end], best[end - times * unit] + unit * brute + math.log10(times))
        if end % UNITS == 0 and end >= 2 * UNITS and min(best[end + 1 - 2 * UNITS : end + 1]) >= enough:
            if end - walk < 2 * UNITS and max(repeated) < UNITS:  # whatever reaches beyond starts in these places
                return enough
    return best[n]


def base_spans(text: str, lower: str | None = None) -> list[Span]:
    """Spans of the fixed patterns, by start and then kind."""
    out, lower = [], text.lower() if lower is None else lower
    if any(k in lower for k in ASSIGN_HINTS):
        out += [Span("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [Span("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [Span("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s.start, KINDS.index(s.kind)))


def spans(text: str | None, min_guesses: float = MIN_GUESSES) -> tuple[list[Span], list[Span]]:
    """The base spans, and the values that the guess cost adds where no base span holds the whole value."""
    if not text:
        return [], []
    lower = text.lower()
    base = base_spans(text, lower)
    added = []
    if any(k in lower for k in CONTEXT_HINTS):
        at = whole = 0
        while m := CONTEXT.search(text, at):
            start = m.end()
            if start >= whole:
                whole = RUN.match(text, start).end()
            at = whole
            if m[2] and (close := text.find(m[2], start, whole)) >= 0:
                at = close
            value = text[start:at].rstrip(".,;:)]}>\"'")
            end = start + len(value)
            taken = any(s.start <= start and end <= s.end for s in base)
            if not taken and len(value) >= 6 and guess_cost(value, min_guesses) >= min_guesses:
                added.append(Span("guess", start, end))
    return base, added


def written(found: list[Span]) -> str:
    return ",".join([f"{s.kind}:{s.start}:{s.end}" for s in found])


def merged(base: list[Span], added: list[Span]) -> list[Span]:
    return sorted([*base, *added], key=lambda s: (s.start, KINDS.index(s.kind)))


def masked(text: str, found: list[Span], mask: str = MASK) -> str:
    """``text`` with every run of overlapping spans replaced by ``mask``."""
    out, at = [], 0
    for s in sorted(found, key=lambda s: s.start):
        if s.start >= at:
            out += [text[at : s.start], mask]
        at = max(at, s.end)
    return "".join([*out, text[at:]])


def scanned(docs: DataFrame, min_guesses: float = MIN_GUESSES) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base, spans, masked) for each row of ``docs`` (doc_id, text).

    base and spans list kind:start:end in code points by start; masked is the text without its secrets. Null and empty
    texts have none; repeated rows each return; other columns are ignored; an empty table gives none. One pass, without
    a shuffle; whole texts, whatever their length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "text"):
            rows = []
            for text in batch.column("text").to_pylist():
                base, added = spans(text, min_guesses)
                found = merged(base, added)
                kinds = [s.kind for s in base]
                rows.append((*(kinds.count(k) for k in KINDS[:3]), written(base), written(found), masked(text, found) if found else text))
            types = [pa.int64()] * 3 + [pa.string()] * 3
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            names = ["doc_id", "n_assign", "n_access", "n_hex", "base", "spans", "masked"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base string, spans string, masked string"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def redacted(docs: DataFrame, min_guesses: float = MIN_GUESSES) -> DataFrame:
    """The rows of ``docs`` with every secret masked, all columns kept; n_chars, where it is there, follows the text.

    Null and empty texts stay as they are, as do repeated rows, rows without an id and an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "text"):
            names, texts = batch.schema.names, batch.column("text").to_pylist()
            for row, text in enumerate(texts):
                if found := merged(*spans(text, min_guesses)):
                    texts[row] = masked(text, found)
            columns = {n: batch.column(n) for n in names}
            columns["text"] = pa.array(texts, columns["text"].type)
            if "n_chars" in columns and pa.types.is_integer(columns["n_chars"].type):
                columns["n_chars"] = pa.array([None if t is None else len(t) for t in texts], columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    return docs.mapInArrow(run, docs.schema)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scanned(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", digest, "spans")
