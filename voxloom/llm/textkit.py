"""Vectorised text kernels on whole UTF-8 buffers: word bounds, word hashes, shingles, lines.

Everything here works on one flat byte buffer of many texts with their bounds, so that the cost per
byte is a few numpy passes and no Python object is made per word. Hashes are 64 bits wide and chain
a non-linear scrambler over eight bytes at a time, so that n different words share a hash with odds
of about n^2 / 2^65 whatever their make-up; spans of over LONG parts take BLAKE2b.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text that one kernel call takes; a longer text makes a call of its own.
CHUNK = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values (the SplitMix64 finaliser)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
LOWER_TABLE = _LOWER.tobytes()


@lru_cache(maxsize=4)
def _powers(size: int, base: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int, base: np.uint64) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; tables are kept at power-of-two sizes."""
    return _powers(1 << max(12, int(n - 1).bit_length()), int(base))[:n]


@dataclass
class Texts:
    """Texts laid end to end: text i is data[bounds[i]:bounds[i + 1]]."""

    data: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, column: pa.Array | pa.ChunkedArray) -> Texts:
        """From an Arrow string column; null is an empty text."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
        if column.null_count:
            column = column.fill_null(b"")
        bounds = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]] if raw is not None and bounds[-1] > bounds[0] else np.zeros(0, np.uint8)
        return cls(data, bounds - bounds[0])

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def chunks(self, limit: int = CHUNK) -> Iterator[tuple[slice, Texts]]:
        """Runs of whole texts of up to limit bytes (one text at least)."""
        i, n = 0, len(self)
        while i < n:
            j = max(i + 1, int(np.searchsorted(self.bounds, self.bounds[i] + limit, "right")) - 1)
            j = min(j, n)
            yield slice(i, j), Texts(self.data[self.bounds[i] : self.bounds[j]], self.bounds[i : j + 1] - self.bounds[i])
            i = j

    def text(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()


@dataclass
class Spans:
    """Spans of a buffer with their 64-bit hashes, and first[i]: the first span of text i."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


#: Parts (eight bytes, or one value) of a span that are chained in numpy; longer spans are hashed one by one.
LONG = 16


def _parts(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as numbers; bytes beyond the end are 0."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray(len(data) + 1, "<u8", padded, 0, (1,))


def _part(parts: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Of each span the part at a position, without the bytes beyond the span."""
    spare = (8 * (8 - np.minimum(left, 8))).astype(np.uint64)
    return (parts[at] << spare) >> spare


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the bytes of each span; equal bytes, equal hashes, wherever they stand."""
    size = end - start
    out, parts = mix(size.astype(np.uint64)), _parts(data)
    live = np.flatnonzero((size > 0) & (size <= 8 * LONG))
    at = 0
    while len(live):
        left = size[live] - at
        out[live] = mix((out[live] + BASE) ^ _part(parts, start[live] + at, left))
        live, at = live[left > 8], at + 8
    for i in np.flatnonzero(size > 8 * LONG):
        out[i] = _long(data[start[i] : end[i]])
    return out


def run_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of runs of 64-bit values; equal runs, equal hashes."""
    size = end - start
    out = mix(size.astype(np.uint64) ^ BASE)
    live = np.flatnonzero((size > 0) & (size <= LONG))
    at = 0
    while len(live):
        out[live] = mix((out[live] + BASE) ^ values[start[live] + at])
        at += 1
        live = live[size[live] > at]
    for i in np.flatnonzero(size > LONG):
        out[i] = _long(values[start[i] : end[i]])
    return out


def _long(values: np.ndarray) -> np.uint64:
    return np.frombuffer(hashlib.blake2b(np.ascontiguousarray(values).tobytes(), digest_size=8).digest(), np.uint64)[0]


def same(data: np.ndarray, start: np.ndarray, size: np.ndarray, other: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Whether size[i] bytes of data from start[i] on are those of other from begin[i] on."""
    out, x, y = np.ones(len(start), bool), _parts(data), _parts(other)
    live, at = np.flatnonzero(size > 0), 0
    while len(live):
        left = size[live] - at
        good = _part(x, start[live] + at, left) == _part(y, begin[live] + at, left)
        out[live] = good
        live, at = live[good & (left > 8)], at + 8
    return out


def words(texts: Texts, lower: bool, within: np.ndarray = ~_SPACE) -> Spans:
    """Words: runs of bytes of within; by default all but space, tab, line feed, vertical tab, form feed, carriage return."""
    raw = texts.data.tobytes()
    if lower:
        raw = raw.translate(LOWER_TABLE)
    data, solid = np.frombuffer(raw, np.uint8), np.zeros(len(raw) + 1, bool)
    solid[:-1] = np.frombuffer(raw.translate(within.tobytes()), bool)
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    inner = texts.bounds[1:-1]
    begins[inner] = solid[inner]  # a new text begins a new word
    ends[:-1] = solid[:-1] & (~solid[1:] | begins[1:])
    start, end = np.flatnonzero(begins[:-1]), np.flatnonzero(ends[:-1]) + 1
    return Spans(start, end, span_hash(data, start, end), np.searchsorted(start, texts.bounds))


def windows(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words inside each text, and the text of each run."""
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(counts)), np.maximum(0, counts - n + 1))
    at = np.arange(len(owner)) - np.repeat(np.cumsum(np.maximum(0, counts - n + 1)) - np.maximum(0, counts - n + 1), np.maximum(0, counts - n + 1)) + first[owner]
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        out = out * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[at + k]
    return mix(out), owner


def shingles(texts: Texts, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The set of n-word shingles of each text (A-Z lower-cased): sorted hashes, and first[i].

    A text of fewer than n words has its whole word sequence as its one shingle; one without words
    has the empty set.
    """
    w = words(texts, lower=True)
    h, owner = windows(w.hash, w.first, n)
    counts = np.diff(w.first)
    few = np.flatnonzero((counts > 0) & (counts < n))
    if len(few):
        own = np.zeros(len(few), np.uint64)
        for k in range(n - 1):
            has = counts[few] > k
            own[has] = own[has] * np.uint64(0xC2B2AE3D27D4EB4F) + w.hash[w.first[few[has]] + k]
        own = mix(own + counts[few].astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
        h, owner = np.concatenate([h, own]), np.concatenate([owner, few])
        order = np.argsort(owner, kind="stable")
        h, owner = h[order], owner[order]
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    for i in np.flatnonzero(np.diff(first) > 1):
        h[first[i] : first[i + 1]].sort()
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[keep], np.concatenate([[0], np.cumsum(keep)])[first]


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of each text's values; 0 for none."""
    total = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def lines(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds of the \\n-split lines: start, end (without the line feed), first[i].

    As with str.split, a text of k line feeds has k + 1 lines, an empty text one empty line.
    """
    feeds = np.flatnonzero(texts.data == 10)
    owner, n = np.searchsorted(texts.bounds, feeds, "right") - 1, len(texts)
    before = np.searchsorted(owner, np.arange(n + 1))  # line feeds before each text
    first, at = np.arange(n + 1) + before, np.arange(len(feeds)) + owner
    starts, ends = np.empty(n + len(feeds), np.int64), np.empty(n + len(feeds), np.int64)
    starts[first[:-1]], starts[at + 1] = texts.bounds[:-1], feeds + 1
    ends[first[1:] - 1], ends[at] = texts.bounds[1:], feeds
    return starts, ends, first


def unused(columns: list[str], *names: str) -> list[str]:
    """names, each with underscores in front until no column is called so (in any case of letters)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
