"""Words of many texts at once, as positions and 64-bit hashes in numpy arrays.

Works on the UTF-8 bytes of an Arrow batch; no Python object per word.  Hashes depend on the bytes
of a word alone, so they agree between tasks and machines.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once (more only for a single longer text).
CHUNK = 1 << 19
LONG_WORD = 2048
BASE = 0x9E3779B97F4A7C15 | 1

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words: everything but white space 0x20, 0x09-0x0D.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words: digits, a-z (after lower-casing) and all of non-ASCII characters.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


class Chunk(NamedTuple):
    """Rows lo..hi of a batch: their lower-cased bytes and where each row's bytes begin."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Per word: first byte, end byte, hash; ``first[d]`` is the number of the first word of row d."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def chunks(texts: pa.Array, size: int = CHUNK) -> Iterator[Chunk]:
    """The rows of a string or binary array in runs of about ``size`` bytes; null is empty."""
    if not len(texts):
        return
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, places, values = texts.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        hi = min(hi, len(texts))
        yield Chunk(lo, hi, LOWER[data[offsets[lo] : offsets[hi]]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(CHUNK + 2 * LONG_WORD, 1 << (n - 1).bit_length())
    if size not in _TABLES:
        _TABLES.clear()
        _TABLES[size] = _powers(BASE, size + 1), _powers(pow(BASE, -1, 1 << 64), size + 1)
    return _TABLES[size]


def find_words(chunk: Chunk, is_word: np.ndarray) -> Words:
    """The maximal runs of word bytes inside each row, with their hashes."""
    data, offsets = chunk.data, chunk.offsets
    n = len(data)
    inside = is_word[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1])) if n else inside
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate((inside[1:], [False])) if n else inside
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(start, end, hash_spans(data, start, end), np.searchsorted(start, offsets))


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash per span of bytes; equal bytes, equal hash."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + CHUNK, "right")))
        base = int(start[i])
        length = int(end[j - 1]) - base
        if length <= CHUNK:
            power, inverse = _tables(length)
            terms = (data[base : base + length].astype(np.uint64) + np.uint64(1)) * power[:length]
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
            a, b = start[i:j] - base, end[i:j] - base
            out[i:j] = mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))
        i = j
    for k in np.flatnonzero(end - start > LONG_WORD):  # few; a hash of the same bytes whatever the chunk
        out[k] = int.from_bytes(blake2b(data[start[k] : end[k]].tobytes(), digest_size=8).digest(), "little")
    return out


def windows(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words inside a row, and the number of each run's first word."""
    total = len(words.hash)
    if total < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = words.hash[: total - n + 1].copy()
    for k in range(1, n):
        value = value * np.uint64(BASE) + words.hash[k : total - n + 1 + k]
    row = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    whole = np.flatnonzero(row[: total - n + 1] == row[n - 1 :])
    return mix(value[whole] + np.uint64(n)), whole
