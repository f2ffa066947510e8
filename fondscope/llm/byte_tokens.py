"""Token ids of whole texts by a public byte-level BPE file (byte_bpe_50k.json), quickly.

Its splitter cuts a text at white space, where one blank goes to the word behind it, and never looks farther; so a text's
ids are those of its chunks, most of which repeat.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

from .tokens import _LETTERS, CHUNKS, PLAIN, _Remembered

# The splitting pattern of the vocabulary file, for plain texts.
_UPPER = _LETTERS.replace("a-z", "A-Za-z")
WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_UPPER}]+| ?[0-9]+| ?[^\s0-9{_UPPER}]+|\s+")
BLANK = "Ġ"
# End of the fixed values.
#: A text's chunks: what stands between white space, with one blank before it, and the rest of the white space.
_CHUNK = re.compile(r" ?[^\t-\r ]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]")
#: Characters that only the file's own splitter judges rightly: controls, other white space, and what isn't a letter in the plain range.
_UNSURE = re.compile("[\x00-\x08\x0e-\x1f\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in such vocabularies: printing Latin-1 characters for themselves, others from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(256 + hidden.index(b)) if b in hidden else chr(b) for b in range(256)]


class ByteEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.all = Tokenizer.from_file(path)
        self.model, self.letters = self.all.model, dict(enumerate(byte_letters()))
        self.forget()

    def forget(self) -> None:
        self.words, self.chunks, self.spaced = (_Remembered(f, CHUNKS) for f in (self._word, self._chunk, self._after_blank))

    def _word(self, w: str) -> bytes:
        shown = w.replace(" ", BLANK) if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _chunk(self, c: str) -> bytes:
        if PLAIN.fullmatch(c):
            return b"".join(map(self.words.__getitem__, WORD.findall(c)))
        return self._whole(c)

    def _after_blank(self, c: str) -> bytes:
        """A blank and the chunk."""
        if c.isalpha() and PLAIN.fullmatch(c):
            return self._word(f" {c}")
        if c[:-1].isalpha() and c[-1] in ".,;:!?" and PLAIN.fullmatch(c):
            return self.spaced[c[:-1]] + self.words[c[-1]]
        return b"".join(map(self.chunks.__getitem__, _CHUNK.findall(f" {c}")))

    def _whole(self, text: str) -> bytes:
        return array("I", self.all.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, text: str) -> bytes:
        if "<|" in text or _UNSURE.search(text):
            return self._whole(text)
        if "  " in text or text.endswith(" "):  # white space whose end decides how it is cut
            return b"".join(map(self.chunks.__getitem__, _CHUNK.findall(text)))
        first, *rest = text.split(" ")
        return b"".join((*map(self.chunks.__getitem__, _CHUNK.findall(first)), *map(self.spaced.__getitem__, rest)))


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)
