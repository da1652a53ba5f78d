"""Words of whole texts as 64-bit numbers, about a megabyte of text at a time.

A word is a run of bytes other than the six ASCII white-space characters; A-Z count as a-z. Words
are hashed by a polynomial over random byte values modulo 2**64, all words of a slice in a few array
operations, and then mixed. Two different words get one number with a probability of about 2**-64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1024 * 1024
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
WORD = r"[^\x20\x09-\x0D]+"

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_is_space = np.zeros(256, dtype=bool)
_is_space[list(SPACES)] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_values = mix(np.arange(1, 257, dtype=np.uint64))
_values[ord("A") : ord("Z") + 1] = _values[ord("a") : ord("z") + 1]


_exact_values = [mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(k)) for k in (1009, 1013)]


class _Powers:
    """Powers of the polynomial's base, as many as the longest slice so far needs."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        return self.up, self.down


_powers = _Powers()


def raw_texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (one more than texts) and bytes of a string or binary array; nulls are empty.

    The bytes are those of the array itself, not a copy.
    """
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, bounds, data = texts.buffers()
    if data is None:
        return np.zeros(len(texts) + 1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    offsets = np.frombuffer(bounds, dtype=np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return offsets - offsets[0], np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]


def compact(texts: pa.Array) -> pa.Array:
    """The same texts, without nulls, in an array whose bytes begin with the first of them."""
    offsets, data = raw_texts(texts)
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_string(), len(texts), buffers)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Consecutive texts of about ``limit`` bytes: first row, offsets, bytes. A longer text is a slice of its own."""
    if not len(texts):
        return
    offsets, data = raw_texts(texts)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        own = offsets[first : last + 1]
        yield first, own - own[0], data[own[0] : own[-1]]
        first = last


@dataclass
class Words:
    """All words of a slice in order: where they begin and end, whose they are, and their numbers."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # of each text, its first word; one entry more than texts
    number: np.ndarray


def words_of(offsets: np.ndarray, data: np.ndarray) -> Words:
    n = len(data)
    inside = ~_is_space[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _powers.upto(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_values[data] * up[:n], out=sums[1:])
    number = (sums[end] - sums[start]) * down[start]
    number = mix(number + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return Words(start, end, np.searchsorted(start, offsets), number)


def names_of(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit numbers of each whole text, case included; together they tell texts apart."""
    up, down = _powers.upto(len(data) + 1)
    found = []
    for values in _exact_values:
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(values[data] * up[: len(data)], out=sums[1:])
        number = (sums[offsets[1:]] - sums[offsets[:-1]]) * down[offsets[:-1]]
        found.append(mix(number + np.diff(offsets).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    return found[0], found[1]


def give_back() -> None:
    """Returns freed memory to the system: a worker process goes on to other tasks, and others share its host."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def in_task(step: Callable[..., Iterator[pa.RecordBatch]], *given) -> Callable:
    """``step`` over a task's batches, for ``mapInArrow``; its memory is given back when it ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from step(batches, *given)
        finally:
            give_back()

    return run


def shingles_of(words: Words, size: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of each text's runs of ``size`` words, repeats included, and where each text's begin.

    A text with fewer words has its whole sequence as one run; a text without words has none.
    """
    counts = np.diff(words.first)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(runs)])
    at = np.repeat(words.first[:-1] - first[:-1], runs) + np.arange(first[-1])
    length = np.repeat(np.minimum(counts, size), runs)
    found = length.astype(np.uint64)
    for k in range(size):
        factor = np.uint64(0xA0761D6478BD642F + 2 * k * 0x5851F42D4C957F2D & (2**64 - 1) | 1)
        there = length > k
        found[there] += mix(words.number[at[there] + k] + np.uint64(k)) * factor
    return mix(found), first
