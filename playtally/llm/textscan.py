"""Words of many texts at once: byte scans of Arrow string arrays in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so that they have inverses
_STEP = 1 << 17  # bytes hashed at a time


def byte_class(*ranges: Iterable[int]) -> np.ndarray:
    """Table of 256 flags: the bytes in any of ``ranges``."""
    table = np.zeros(256, dtype=bool)
    for some in ranges:
        table[list(some)] = True
    return table


# Every byte but the six white-space characters.
NOT_SPACE = ~byte_class([0x20], range(0x09, 0x0E))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(2 * len(_BASES))
def _powers(base: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size, base, np.uint64))))


def _polynomials(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """``sum((byte + 1) * base ** place)`` of every word, modulo 2 ** 64: differences of running
    sums over some words at a time, moved back to place 0 by the base's inverse."""
    out, inverse, i = np.zeros(len(starts), np.uint64), pow(base, -1, 1 << 64), 0
    while i < len(starts):
        low = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, low + _STEP, side="right")))
        size = int(ends[j - 1] - low)
        # A word longer than a step has tables of its own, which are not remembered.
        table = _powers if size <= _STEP else _powers.__wrapped__
        power, back = table(base, max(size, _STEP)), table(inverse, _STEP)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum((raw[low:low + size].astype(np.uint64) + np.uint64(1)) * power[:size], out=sums[1:])
        out[i:j] = (sums[ends[i:j] - low] - sums[starts[i:j] - low]) * back[starts[i:j] - low]
        i = j
    return out


def scan_words(texts: pa.Array, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit ids of all texts' words, and where each text's words begin (one entry more).

    A word is a maximal run of ``word_bytes`` after lower-casing A-Z. Its id folds two
    polynomial hashes of its bytes and its length. ``texts`` has no nulls.
    """
    binary = texts.cast(pa.large_binary())
    offsets = np.frombuffer(binary.buffers()[1], dtype=np.int64)[binary.offset:binary.offset + len(binary) + 1]
    none = np.zeros(0, np.uint64), np.zeros(len(binary) + 1, np.int64)
    if not len(binary) or offsets[-1] == offsets[0]:
        return none
    raw = _LOWER[np.frombuffer(binary.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]]
    offsets = offsets - offsets[0]
    word = word_bytes[raw]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(raw)]
    begins[cuts] = word[cuts]  # a text's first byte never continues the text before
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    ends[cuts[cuts > 0] - 1] = word[cuts[cuts > 0] - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    if not len(starts):
        return none
    ids = np.zeros(len(starts), np.uint64)
    with np.errstate(over="ignore"):
        for base in _BASES:
            ids = mix(ids ^ _polynomials(raw, starts, ends, base)) + (ends - starts).astype(np.uint64)
    return ids, np.searchsorted(starts, offsets)


def shards(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """Consecutive whole texts of about ``size`` bytes together (a longer text alone)."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield texts.slice(at, stop - at)
        at = stop
