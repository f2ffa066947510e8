"""Word and shingle hashes of whole Arrow batches, computed on the UTF-8 bytes with numpy.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D (those bytes never occur inside another character).
`Words` walks a batch in slices of about SLICE bytes, so memory doesn't follow the length of the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE = 1 << 17
SHINGLE = 5
#: Distinct shingles are kept as one number: the record's place in its slice, then HASH_BITS of the hash.
HASH_BITS = 50
RECORDS = 1 << (64 - HASH_BITS)
_U = np.uint64
_STEPS = [_U(x) for x in (1, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]
_SHORT = _U(0x2545F4914F6CDD1D)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def is_space(b: np.ndarray) -> np.ndarray:
    return (b == 32) | ((b - np.uint8(9)) <= 4)


def lowered(b: np.ndarray) -> np.ndarray:
    """A-Z as a-z; other bytes, and so other characters, stay."""
    return b + ((b - np.uint8(65)) <= 25).astype(np.uint8) * np.uint8(32)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row's begin (one more entry than rows); null is empty."""
    column = column.cast(pa.large_string()).fill_null("") if len(column) else pa.array([], pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), at


def word_hashes(b: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of every word of `b`; a word also ends at each of `cuts` (places in b)."""
    n = len(b)
    if not n:
        return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = is_space(b)
    fresh = np.empty(n + 1, bool)
    fresh[0] = fresh[n] = True
    fresh[1:n] = space[:-1]
    fresh[cuts] = True
    start = np.flatnonzero(fresh[:-1] & ~space)
    stop = np.empty(n, bool)
    stop[:-1] = space[1:] | fresh[1:n]
    stop[-1] = True
    end = np.flatnonzero(stop & ~space) + 1
    return _hashed(b, start, end - start), start, end


def _hashed(b: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hash of the bytes b[start:start + length]: each 8 of them are mixed with their place before they are summed, so that what
    cancels in one place of a sum needn't in another."""
    padded = np.concatenate([b, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(b) + 1,), "<u8", padded, 0, (1,))  # the 8 bytes that begin at each place
    parts = (length + 7) >> 3
    first = np.cumsum(parts) - parts
    if not len(start) or parts[-1] + first[-1] == len(start):  # no word of more than 8 bytes
        at, left, salt = start, length, _STEPS[2]
    else:
        nth = np.arange(int(parts.sum())) - np.repeat(first, parts)
        at, left = np.repeat(start, parts) + 8 * nth, np.repeat(length, parts) - 8 * nth
        salt = (nth.astype(_U) + _U(1)) * _STEPS[2]
    kept = np.minimum(left, 8).astype(_U) << _U(3)
    h = mixed((eight[at] & (~_U(0) >> (_U(64) - kept))) ^ salt)
    if len(h) > len(start):
        h = np.add.reduceat(h, first)
    return mixed(h + length.astype(_U) * _STEPS[1])


class Slice(NamedTuple):
    """Words of some whole records. counts: words of each; first: number of the first record."""

    first: int
    counts: np.ndarray
    hashes: np.ndarray


def slices(data: np.ndarray, at: np.ndarray, lower: bool = True) -> Iterator[Slice]:
    """Words of the records data[at[i]:at[i + 1]], some whole records at a time."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + SLICE, "right")) - 1)
        j = min(j, i + RECORDS)
        if at[j] - at[i] <= 2 * SLICE:
            b = data[at[i] : at[j]]
            cuts = at[i:j] - at[i]
            h, start, _ = word_hashes(lowered(b) if lower else b, cuts)
            marks = np.searchsorted(start, np.r_[cuts, len(b)])
            yield Slice(i, np.diff(marks), h)
        else:  # one long record, cut between words
            j, parts, a, z = i + 1, [], int(at[i]), int(at[i + 1])
            while a < z:
                e = min(z, a + SLICE)
                while e < z and not is_space(data[e : e + 1])[0]:
                    gap = np.flatnonzero(is_space(data[e : min(z, e + SLICE)]))
                    e = e + int(gap[0]) if len(gap) else min(z, e + SLICE)
                b = data[a:e]
                parts.append(word_hashes(lowered(b) if lower else b, np.zeros(1, np.int64))[0])
                a = e
            h = np.concatenate(parts)
            yield Slice(i, np.array([len(h)]), h)
        i = j


def shingles(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Record (from 0 in the slice) and hash of each shingle in order: five words, or all of a shorter record as one."""
    h, counts = s.hashes, s.counts
    first = np.cumsum(counts) - counts
    rec = np.repeat(np.arange(len(counts)), counts)
    if len(h) >= SHINGLE:
        m = len(h) - SHINGLE + 1
        whole = rec[:m] == rec[SHINGLE - 1 :]
        v = h[:m].copy()
        for k in range(1, SHINGLE):
            v += h[k : k + m] * _STEPS[k]
        full, full_rec = mixed(v[whole]), rec[:m][whole]
    else:
        full, full_rec = np.zeros(0, _U), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if not len(short):
        return full_rec, full
    v = np.zeros(len(short), _U)
    for k in range(SHINGLE - 1):
        has = counts[short] > k
        v[has] += h[first[short[has]] + k] * _STEPS[k]
    v = mixed(v + counts[short].astype(_U) * _SHORT)
    rec, v = np.r_[full_rec, short], np.r_[full, v]
    order = np.argsort(rec, kind="stable")
    return rec[order], v[order]


def short_shingles(s: Slice, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and hash of all `size` words in a row, fewer than SHINGLE, within a record: as the shingle of a record of these words."""
    rec = np.repeat(np.arange(len(s.counts)), s.counts)
    m = max(0, len(rec) - size + 1)
    at = np.flatnonzero(rec[:m] == rec[size - 1 :])
    v = np.zeros(len(at), _U)
    for k in range(size):
        v += s.hashes[at + k] * _STEPS[k]
    return at, mixed(v + _U(size) * _SHORT)


def distinct_shingles(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Record and hash of each record's distinct shingles, by record and hash; and how many each record has."""
    rec, v = shingles(s)
    key = np.sort((rec.astype(_U) << _U(HASH_BITS)) | (v >> _U(64 - HASH_BITS)))
    key = key[np.r_[True, key[1:] != key[:-1]]] if len(key) else key
    rec = (key >> _U(HASH_BITS)).astype(np.int64)
    return rec, key & _U((1 << HASH_BITS) - 1), np.bincount(rec, minlength=len(s.counts))
