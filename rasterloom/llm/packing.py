"""Packing by power-of-two decomposition: a sequence is one piece of one document.

A document of n tokens becomes n // 2048 pieces of 2048 and a piece for each set bit of the rest, longest first. Pieces
of one length share a bucket, so a batch drawn from a bucket needs no padding and no sequence crosses documents
(Pouransari et al., 2024). It is one pass without a shuffle.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rasterloom.llm.common import sub_batches, table

LENGTH = 2048
END_ID = 1
#: Bytes of text whose pieces are held at a time.
BYTES = 1 << 20
#: Words and pieces that a Python worker remembers; the memory is emptied beyond it.
CACHE = 300_000
SCHEMA = (
    "doc_id long, start long, length long, bucket int, ids binary, doc_tokens long, sequence_id long, offset long"
)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(others)) for b in range(256)]


#: Fixed form of a tokenizer file whose texts fall into words: white space is one space, letters are lower-cased, and no
#: piece joins characters across white space, nor a letter or digit with a full stop or comma.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def falls_into_words(path: str) -> bool:
    """Whether the tokenizer file has the fixed form, and no added token with white space."""
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    added = [t["content"] for t in found.get("added_tokens") or []]
    return found["normalizer"] == NORMALIZER and found["pre_tokenizer"] == PRE_TOKENIZER and all(len(t.split()) == 1 for t in added)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordIds(dict):
    """White-space free UTF-8 words to their ids, packed as little-endian unsigned 32-bit numbers.

    Where the tokenizer's texts fall into words, these are looked up one by one; a word of Latin letters is a single piece
    and goes straight to the merges. All else, and whole texts for a tokenizer of another form, go through the whole
    tokenizer.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_word = falls_into_words(path)
        self.merge = self.tokenizer.model.tokenize
        self.bytes = byte_alphabet()

    def __missing__(self, word: bytes) -> bytes:
        core = word.rstrip(b".,")
        if core.isalpha():  # of bytes: Latin letters without marks
            found = self.letters(core.lower())
            if len(core) < len(word):
                found += self[word[len(core) :]]
        else:
            text = word.decode("utf-8", "replace")
            core = text.rstrip(".,")
            # Normalising can end a letter beyond these in a mark, which would go with the full stop.
            if core != text and core and core[-1].isalnum() and core[-1] < "İ":
                found = self.piece(core) + self.piece(text[len(core) :])
            else:
                found = self.piece(text)
        return self.kept(word, found)

    def letters(self, word: bytes) -> bytes:
        """The ids of lower-cased letters a to z."""
        found = self.get(word)
        return self.kept(word, _packed([t.id for t in self.merge(word.decode())])) if found is None else found

    def piece(self, text: str) -> bytes:
        latin = text.isalpha() and max(text) < "Ā"
        key = text.lower() if latin else text
        found = self.get(key)
        if found is None:
            if latin:
                mapped = "".join([self.bytes[b] for b in key.encode()])
                ids = [t.id for t in self.merge(mapped)]
            else:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            found = self.kept(key, _packed(ids))
        return found

    def kept(self, key: str | bytes, found: bytes) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        if len(key) <= 64:
            self[key] = found
        return found

    def ids(self, text: str | None) -> bytes:
        if text is None:
            return b""
        if not self.by_word:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join([self[w] for w in text.encode("utf-8", "replace").split()])


_known: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One table for each Python worker, kept between its tasks."""
    if path not in _known:
        _known[path] = WordIds(path)
    return _known[path]


def cuts(total: int, length: int = LENGTH) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of ``total`` tokens; ``length`` is a power of two."""
    start = 0
    while total - start >= length:
        yield start, length
        start += length
    while start < total:
        size = 1 << (total - start).bit_length() - 1
        yield start, size
        start += size


def packed(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text): ``SCHEMA``; ids are little-endian unsigned 32-bit, bucket is log2 of length.

    Every document ends with ``end_id``; a null, empty or blank text has that id alone. Rows are packed one by one, so
    repeated ids and rows, null ids and extra columns change nothing; an empty table has no pieces. sequence_id is
    unique and, for the same input files, the same again. Each sequence holds one piece, at offset 0, without padding.
    """
    if length < 1 or length & (length - 1):
        raise ValueError("length must be a power of two")
    end = end_id.to_bytes(4, "little")
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ids, number = word_ids(tokenizer), TaskContext.get().partitionId() << 40
        for batch in sub_batches(batches, "text", BYTES):
            out: list[list] = [[] for _ in names]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = table_ids.ids(text) + end
                total = len(ids) // 4
                for start, size in cuts(total, length):
                    values = (doc_id, start, size, size.bit_length() - 1, ids[4 * start : 4 * (start + size)], total, number, 0)
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                    number += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def digest(pieces: DataFrame) -> DataFrame:
    crc = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset", "bucket")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(packed(table(spark, sf_dir, "documents"), default_tokenizer()))
