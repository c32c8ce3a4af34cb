"""Words of many texts at once, as positions and 64-bit hashes in numpy arrays."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BYTE = np.arange(256)
#: A-Z as a-z, all other bytes as they are
LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing: digits, letters, every byte of a longer character
ALNUM = ((_BYTE >= 48) & (_BYTE <= 57)) | ((LOWER >= 97) & (LOWER <= 122)) | (_BYTE >= 128)
#: [^\x20\x09-\x0D]
NOT_SPACE = ~((_BYTE == 32) | ((_BYTE >= 9) & (_BYTE <= 13)))

BASE = 0x9E3779B97F4A7C15 | 1
_PIECE = 1 << 18


@lru_cache(maxsize=4)
def powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    k = 1
    while k < n:
        step = np.uint64(pow(base, k, 1 << 64))
        out[k:2 * k] = out[:min(k, n - k)] * step
        k *= 2
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA3B195354A39B70D)
    return x ^ (x >> np.uint64(32))


@dataclass
class Words:
    """Per word its text's index, first byte and end in ``data``, and hash; texts lie end to end."""

    data: np.ndarray
    offsets: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=len(self.offsets) - 1)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end and where each begins; NULL is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()) if not pa.types.is_binary(texts.type) else texts.cast(pa.large_binary()),
                         b"" if pa.types.is_binary(texts.type) else "")
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[at[0]:at[-1]], at - at[0]


def find_words(texts: pa.Array, word_bytes: np.ndarray) -> Words:
    """All words of all texts in order, hashed after lower-casing A-Z."""
    data, offsets = utf8(texts)
    inside = word_bytes[data]
    first, last = inside.copy(), inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        full = offsets[1:] > offsets[:-1]
        starts, ends = offsets[:-1][full], offsets[1:][full] - 1
        first[starts] = inside[starts]
        last[ends] = inside[ends]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    return Words(data, offsets, doc, start, end, hash_bytes(data, start, end))


def hash_bytes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of runs of lower-cased bytes, of which neither starts nor ends fall."""
    out = np.empty(len(start), np.uint64)
    longest = int((end - start).max()) if len(start) else 0
    reach = _PIECE + (1 << longest.bit_length())
    up, down = powers(BASE, reach), powers(pow(BASE, -1, 1 << 64), reach)
    codes = (LOWER.astype(np.uint64) + np.uint64(1))
    i = 0
    while i < len(start):
        a = start[i]
        j = max(i + 1, int(np.searchsorted(start, a + _PIECE)))
        b = end[j - 1]
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(codes[data[a:b]] * up[:b - a], out=sums[1:])
        s, e = start[i:j] - a, end[i:j] - a
        out[i:j] = (sums[e] - sums[s]) * down[s]
        i = j
    return mix(out)


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words, by the position of its first word."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9FB21C651E98DF25) + words[j:j + n]
    return mix(out)
