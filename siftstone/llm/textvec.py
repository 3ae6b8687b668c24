"""Vectorised words, rolling hashes and winnowing over Arrow text buffers.

All functions work on the UTF-8 bytes of many documents at once, so the cost
per word is a few nanoseconds of numpy rather than a Python object.  A word's
hash is the sum of random values of its (place, byte) pairs, followed by a
bijective mixer, so that no structure of the letters can make two words meet;
runs of words have polynomial hashes modulo 2**64 over those.  Hashes depend on
nothing but the bytes: every executor gives the same value for the same words.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Documents are grouped into slices of about this many bytes before numpy sees them.
SLICE_BYTES = 1 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)
_GRAM_BASE = np.uint64(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (the splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))



Key = tuple[int, int]


def new_key() -> Key:
    return secrets.randbits(64), secrets.randbits(64)


def _values(place: np.ndarray, byte: np.ndarray, key: Key) -> np.ndarray:
    at = (place.astype(np.uint64) * np.uint64(256) + byte + np.uint64(1)) * _STEP
    return mix(mix(at ^ np.uint64(key[0])) + np.uint64(key[1]))


#: The first places of a word, whose values are kept; those further on are computed.
_PLACES = 32


@lru_cache(maxsize=4)
def _table(key: Key) -> np.ndarray:
    return _values(np.repeat(np.arange(_PLACES), 256), np.tile(np.arange(256, dtype=np.uint64), _PLACES), key)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _powers(base: np.uint64, n: int, cache: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    """base**0..n-1 and their inverses modulo 2**64."""
    have = cache.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(10, (n - 1).bit_length())
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        have = tuple(np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(size - 1, b, np.uint64))]) for b in (base, inverse))
        cache[base] = have
    return have


@dataclass
class Words:
    """Words of a slice of documents; `first[d]:first[d+1]` are the words of its d-th document."""

    buf: np.ndarray  # bytes of the slice
    starts: np.ndarray  # byte offsets into buf
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray  # uint64

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words_of(buf: np.ndarray, offsets: np.ndarray, key: Key, lower: bool = False) -> Words:
    """Maximal runs of bytes other than space and 0x09-0x0D within each document.

    buf holds the documents one after the other; offsets has their bounds.
    """
    if lower:
        buf = _LOWER[buf]
    n = len(buf)
    solid = np.zeros(n + 2, dtype=bool)
    solid[1:-1] = ~_SPACE[buf]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    starts = np.flatnonzero(solid[1:-1] & (~solid[:-2] | cut[:-1]))
    ends = np.flatnonzero(solid[1:-1] & (~solid[2:] | cut[1:])) + 1
    first = np.searchsorted(starts, offsets)
    place = np.zeros(n, dtype=np.int32)
    place[starts] = starts
    place = np.arange(n, dtype=np.int32) - np.maximum.accumulate(place)
    value = _table(key)[np.minimum(place, _PLACES - 1) << 8 | buf]
    far = np.flatnonzero(place >= _PLACES)
    if len(far):
        value[far] = _values(place[far], buf[far], key)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(value, out=sums[1:])
    hashes = mix(sums[ends] - sums[starts] + (ends - starts).astype(np.uint64))
    return Words(buf, starts, ends, first, hashes)


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of hashes[i:i+size] for each i with that many left (documents not regarded)."""
    n = len(hashes)
    if n < size:
        return np.empty(0, dtype=np.uint64)
    power, inverse = _powers(_GRAM_BASE, n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * power[:n], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * inverse[: n - size + 1] + np.uint64(size))


def range_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of hashes[a:b] for each a, b of starts and ends."""
    power, inverse = _powers(_GRAM_BASE, len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * power[: len(hashes)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def inside(first: np.ndarray, n_words: int, size: int) -> np.ndarray:
    """Which windows words[i:i+size] lie in one document (True), for i up to n_words - size."""
    count = max(0, n_words - size + 1)
    ok = np.ones(count, dtype=bool)
    for back in range(1, size):  # windows that start up to size-1 before a bound cross it
        at = first[1:-1] - back
        ok[at[(at >= 0) & (at < count)]] = False
    # A bound may lie less than size-1 before the next: marking by bounds covers that too.
    return ok


def winnow(kgrams: np.ndarray, window: int) -> np.ndarray:
    """For each i the position of the least of kgrams[i:i+window], the rightmost of equals."""
    n = len(kgrams) - window + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    best, at = kgrams[:n].copy(), np.zeros(n, dtype=np.int8)
    for k in range(1, window):
        other = kgrams[k : k + n]
        take = other <= best
        np.copyto(best, other, where=take)
        at[take] = k
    return np.arange(n) + at


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about limit bytes; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        texts, kind = texts.cast(pa.string()), np.int32
    n = len(texts)
    if not n:
        return
    _, off, data = texts.buffers()
    offs = np.frombuffer(off, dtype=kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    if texts.null_count:  # a null may cover bytes: leave them out
        valid = texts.is_valid().to_numpy(zero_copy_only=False)
        size = np.where(valid, np.diff(offs), 0)
        if (size != np.diff(offs)).any():
            data = np.concatenate([data[offs[i] : offs[i] + size[i]] for i in range(n)] or [data[:0]])
            offs = np.concatenate([[0], np.cumsum(size)])
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + limit, side="right")) - 1)
        b = min(b, n)
        yield a, b, data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
        a = b
