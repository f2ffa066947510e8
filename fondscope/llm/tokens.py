"""Token ids of whole texts by a public tokenizer file, as Arrow batches of pieces."""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_or_empty

CAPACITY = 2048
SEPARATOR = 0
#: Chunks between white space, and words in them, that a task remembers with their ids (about 150 bytes each); of later ones it
#: remembers none.
CHUNKS, WORDS = 1 << 19, 1 << 19
#: Texts and chunks for which lower-casing character by character is str.lower, and normalization changes nothing.
_LETTERS = "a-zÀ-ÖØ-öø-įı-ɏ"
PLAIN = re.compile(r"[\t-\r\x20-\x7eÀ-įı-ɏ]*")
_SPACE = re.compile(r"[\t-\r ]+")
# Fixed value: the splitting pattern of the vocabulary file, for lower-cased plain texts.
WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\s0-9{_LETTERS}]+")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


class _Remembered(dict):
    """Values of `f`, of the first `most` keys that are asked for."""

    def __init__(self, f: Callable[[str], bytes], most: int):
        super().__init__()
        self.f, self.most = f, most

    def __missing__(self, key: str) -> bytes:
        value = self.f(key)
        if len(self) < self.most and len(key) < 256:
            self[key] = value
        return value


class Encoder:
    """Ids of texts by a tokenizer file that lower-cases, splits by WORD and drops white space.

    Chunks between white space are encoded one by one and remembered, since most chunks of a corpus repeat: the file's
    normalizer and splitter never look across white space. The words of a plain text's chunks go to the file's model, the chunks of
    other texts, if they aren't plain themselves, to the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.all = Tokenizer.from_file(path)
        self.model, self.split = self.all.model, self.all.pre_tokenizer.pre_tokenize_str
        self.forget()

    def forget(self) -> None:
        self.words, self.chunks, self.odd = (_Remembered(f, n) for f, n in ((self._word, WORDS), (self._chunk, CHUNKS), (self._odd, CHUNKS)))

    def _word(self, w: str) -> bytes:
        shown = w if w.isascii() else "".join(x for x, _ in self.split(w))
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _chunk(self, c: str) -> bytes:
        if c.isalpha():
            return self.words[c]
        if c[:-1].isalpha() and c[-1] in ".,;:!?":
            return self.words[c[:-1]] + self.words[c[-1]]
        return b"".join(map(self.words.__getitem__, WORD.findall(c)))

    def _odd(self, c: str) -> bytes:
        if PLAIN.fullmatch(c) and "<|" not in c:
            return self.chunks[c.lower()]
        return array("I", self.all.encode(c, add_special_tokens=False).ids).tobytes()

    def __call__(self, text: str) -> bytes:
        if PLAIN.fullmatch(text) and "<|" not in text:
            return b"".join(map(self.chunks.__getitem__, text.lower().split()))
        return b"".join(map(self.odd.__getitem__, filter(None, _SPACE.split(text))))


_encoder = lru_cache(maxsize=2)(Encoder)


def forgetting(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's batches; at its end the worker, which serves other tasks too, drops what it has remembered."""
    try:
        yield from batches
    finally:
        _encoder(path).forget()


def ids_of(text: str, path: str) -> bytes:
    """The text's ids as little-endian unsigned 32-bit numbers, followed by SEPARATOR."""
    return _encoder(path)(text) + SEPARATOR.to_bytes(4, "little")


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of each row of `docs` (doc_id, text): its ids cut every `capacity`.

    Null texts count as empty: one piece of one id. A text's ids are never cut short; repeated rows give their pieces again.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    step = 4 * capacity

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = ids_of(text, path)
            for k, at in enumerate(range(0, len(ids), step)):
                part = ids[at : at + step]
                yield (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)) + ((part,) if with_ids else ())

    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def cut(batches):
        for batch in forgetting(path, batches):
            got = list(zip(*rows(batch), strict=True))
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(got, types, strict=True)], names)

    return docs.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)
