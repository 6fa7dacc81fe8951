"""Vectorised word splitting and hashing over Arrow string columns, for use inside tasks.

A batch is worked on in slices of bounded bytes, so memory follows the slice
(or the longest single text), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 1 << 20
LONG_WORD = 64  # longer words are hashed one by one: the polynomial below is for short ones

# Fixed byte classes: white space ends a word, or everything but 0-9, a-z and non-ASCII does.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[0x41:0x5B] += 0x20

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (every output bit depends on every input bit)."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n (the base is odd, so it has an inverse)."""
    got = _POWERS.get(base)
    if got is None or len(got[0]) < n:
        n = max(n, 1 << 16)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        got = _POWERS[base] = (both[0], both[1])
    return got


def _ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of each values[start:end], by prefix sums modulo 2^64."""
    up, down = _powers(base, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


@dataclass
class Words:
    """The words of a slice of texts: byte ranges, and the range of words of each text."""

    data: np.ndarray    # the bytes of all texts, one after another
    starts: np.ndarray  # of each word
    ends: np.ndarray
    bounds: np.ndarray  # text i has the words bounds[i]:bounds[i + 1]

    def hashes(self, which: int = 0) -> np.ndarray:
        """A 64-bit hash of each word; ``which`` picks one of two independent ones."""
        size = self.ends - self.starts
        h = _ranges(self.data.astype(np.uint64) + np.uint64(1), self.starts, self.ends, _BASES[which])
        h = mix(h + size.astype(np.uint64) * np.uint64(_BASES[1 - which]))
        for i in np.flatnonzero(size > LONG_WORD):
            h[i] = xxhash.xxh3_64_intdigest(self.data[self.starts[i]:self.ends[i]].tobytes(), seed=which)
        return h

    def stem_hashes(self, sizes: tuple[int, ...]) -> np.ndarray:
        """A row per size: a hash of each word's first so many bytes; of words that aren't longer, the whole word's."""
        out = np.empty((len(sizes), len(self.starts)), np.uint64)
        whole = self.hashes()
        values = self.data.astype(np.uint64) + np.uint64(1)
        up, down = _powers(_BASES[0], len(values) + 1)
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:len(values)], out=total[1:])
        for row, size in zip(out, sizes):
            longer = self.ends - self.starts > size
            stem = mix((total[np.minimum(self.starts + size, self.ends)] - total[self.starts]) * down[self.starts] + np.uint64(size))
            row[:] = np.where(longer, stem, whole)
        return out

    def text_of(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()

    def joined(self, first: int, last: int) -> bytes:
        """Words first:last with one space between."""
        raw = self.data
        return b" ".join(raw[a:b].tobytes() for a, b in zip(self.starts[first:last], self.ends[first:last]))


def window_hashes(word_hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each word sequence starts:ends."""
    size = (ends - starts).astype(np.uint64)
    return mix(_ranges(word_hashes, starts, ends, _BASES[1 - which]) + size * np.uint64(_BASES[which]))


def slices(batch: pa.RecordBatch | pa.Table, text_col: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows of up to ``limit`` text bytes, one row at least."""
    sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(text_col)), 0)
                                 .to_numpy(zero_copy_only=False), np.int64)) if batch.num_rows else np.zeros(0)
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, before + limit, "right")))
        yield batch.slice(at, end - at)
        at = end


def split_words(texts: pa.Array, ends_word: np.ndarray = SPACE, lower: bool = False) -> Words:
    """The words of each text (null: none): maximal runs of bytes outside ``ends_word``."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    n = len(texts)
    offs = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = texts.buffers()[2] if n else None
    data = (np.frombuffer(raw, np.uint8)[offs[0]:offs[-1]] if raw is not None and offs[-1] > offs[0]
            else np.zeros(0, np.uint8))
    offs = offs - offs[0]
    if lower:
        data = TO_LOWER[data]
    inside = ~ends_word[data]
    edge = offs[(offs > 0) & (offs < len(data))]  # a text's first byte follows nothing
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[edge] = inside[edge]
    stops[:-1] &= ~inside[1:]
    stops[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offs))
