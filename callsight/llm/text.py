"""Vectorised text helpers shared by the operators: words and shingles as 64-bit hashes.

All functions work on whole Arrow string columns without making Python strings. A word
is a maximal run of characters other than space and TAB..CR (``[^\\x20\\x09-\\x0D]+``); as
every byte of a non-ASCII character is above 0x7F, runs of bytes and runs of characters
are the same. Letters A-Z may be lower-cased; nothing else is changed.

A hash is a polynomial over a table of random 64-bit values, finished by a 64-bit
mixer, so two different words collide with a probability of about 2**-64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 2**64)
PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) * U64(2) + U64(1)

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: punctuation behind an ASCII letter, where :func:`words` may cut as well
IS_LETTER = np.zeros(256, dtype=bool)
IS_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
IS_STOP = np.zeros(256, dtype=bool)
IS_STOP[list(b".,;:!?")] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

#: bytes of text hashed at once; the working arrays take about 40 times as much
CHUNK = 1 << 18
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        p = np.empty(max(n, CHUNK + 1), dtype=np.uint64)
        p[0] = 1
        done = 1
        while done < len(p):
            k = min(done, len(p) - done)
            p[done : done + k] = p[:k] * U64(pow(base, done, 2**64))
            done += k
        _powers[base] = have = p
    return have[:n]


def give_back() -> None:
    """Returns the memory of freed arrays to the system. Workers live on between tasks, and
    what their allocators hold back counts against the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    if not len(col):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and offs[-1] else np.empty(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def _hash_piece(data: np.ndarray, starts_here: np.ndarray, lower: bool, at_stops: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, start and end of every word of one piece. ``starts_here``: places
    at which a text begins, where a word cannot go on."""
    space = IS_SPACE[data]
    fresh = np.empty(len(data), dtype=bool)  # the byte before is a space or of another text
    fresh[0] = True
    fresh[1:] = space[:-1]
    if at_stops:
        fresh[1:] |= IS_STOP[data[1:]] & IS_LETTER[data[:-1]]
    fresh[starts_here] = True
    begin = np.flatnonzero(fresh & ~space)
    last = np.empty(len(data), dtype=bool)
    last[-1] = True
    last[:-1] = fresh[1:] | space[1:]
    end = np.flatnonzero(last & ~space) + 1
    if lower:
        data = LOWER[data]
    total = np.empty(len(data) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(BYTE_VALUE[data] * _power(BASE, len(data)), out=total[1:])
    h = (total[end] - total[begin]) * _power(BASE_INVERSE, len(data))[begin]
    return mix(h ^ ((end - begin).astype(np.uint64) * PLACE[63])), begin, end


def words(data: np.ndarray, offs: np.ndarray, lower: bool = True, at_stops: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of all texts, one after another, with each word's start and end byte,
    and the index of each text's first word (one more than texts). ``at_stops`` also cuts
    words in front of punctuation behind an ASCII letter. Works through the bytes in
    pieces of about ``CHUNK``, cut where a word ends."""
    hashes, begins, ends = [], [], []
    lo, n = 0, len(data)
    while lo < n:
        hi = min(n, lo + CHUNK)
        while hi < n:  # to the next space or the next text
            ahead = np.flatnonzero(IS_SPACE[data[hi : hi + CHUNK]])
            stop = hi + int(ahead[0]) if len(ahead) else min(n, hi + CHUNK)
            k = int(np.searchsorted(offs, hi))
            if k < len(offs) and offs[k] <= stop:
                hi = int(offs[k])
                break
            hi = stop
            if len(ahead):
                break
        at = offs[np.searchsorted(offs, lo) : np.searchsorted(offs, hi)] - lo
        h, b, e = _hash_piece(data[lo:hi], at, lower, at_stops)
        hashes.append(h)
        begins.append(b + lo)
        ends.append(e + lo)
        lo = hi
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offs), np.int64)
    begin = np.concatenate(begins)
    return np.concatenate(hashes), begin, np.concatenate(ends), np.searchsorted(begin, offs)


def ngrams(word: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words inside a text, and the index of each text's first."""
    count = np.maximum(np.diff(first) - (n - 1), 0)
    at = np.zeros(len(first), dtype=np.int64)
    np.cumsum(count, out=at[1:])
    if not at[-1]:
        return np.empty(0, np.uint64), at
    if len(word) < n:
        return np.empty(0, np.uint64), np.zeros_like(at)
    h = word[: len(word) - n + 1] * PLACE[0]
    for i in range(1, n):
        h += word[i : len(word) - n + 1 + i] * PLACE[i]
    index = np.arange(at[-1]) + np.repeat(first[:-1] - at[:-1], count)
    return mix(h[index] + PLACE[32 + n]), at


def shingle_sets(col: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of ``n`` lower-cased words; a text
    with fewer words has its whole sequence as one, a text without words none."""
    data, offs = string_buffers(col)
    word, _, _, first = words(data, offs)
    gram, at = ngrams(word, first, n)
    for i in range(len(offs) - 1):
        if at[i + 1] > at[i]:
            yield np.unique(gram[at[i] : at[i + 1]])
        elif first[i + 1] > first[i]:
            own = word[first[i] : first[i + 1]]
            yield mix(np.sum(own * PLACE[: len(own)], keepdims=True) + PLACE[48 + len(own)])
        else:
            yield np.empty(0, np.uint64)


def by_bytes(col: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges that hold about ``most`` bytes of text each (at least one row)."""
    sizes = np.diff(string_buffers(col)[1])
    total = np.cumsum(sizes)
    lo = 0
    while lo < len(sizes):
        before = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, before + most, side="right")))
        yield lo, hi
        lo = hi


def strings(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[str]:
    """The texts at these places."""
    size = end - begin
    offs = np.zeros(len(size) + 1, dtype=np.int64)
    np.cumsum(size, out=offs[1:])
    held = data[np.arange(offs[-1]) + np.repeat(begin - offs[:-1], size)]
    return pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(offs), pa.py_buffer(held)]).to_pylist()
