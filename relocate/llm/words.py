"""Words of many texts at once, as arrays: borders, hashes, and hashes of runs of words.

A word is a run of bytes other than 0x20 and 0x09-0x0D. Each has two 64-bit hashes, the same on every machine: the sum
of a random number for each byte at each place, from one table or another, and for words of more than ``PLACES`` bytes
half of a BLAKE2b digest. No arithmetic ties the numbers of a table together, so two words that differ share one hash
with a chance of 2**-64, whatever they are made of, and both with one of 2**-128. Hashes of runs are mixed from those
of their words, one kind at a time, and so are as independent of each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
PLACES = 64
_HASH_BYTES = 1 << 19

_TABLES = np.random.Generator(np.random.PCG64(20240607)).integers(0, 2**64, (2, PLACES << 8), dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of some texts: word ``i`` is ``data[starts[i]:ends[i]]``; text ``t`` has ``bounds[t]:bounds[t + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    _found: dict[tuple[bool, bool], np.ndarray] = field(default_factory=dict)

    def hashes(self, lower: bool = False, second: bool = False) -> np.ndarray:
        """The first or second hash of each word, as it stands or with A-Z lower-cased."""
        if (lower, second) not in self._found:
            self._found[lower, second] = self._hashes(lower, second)
        return self._found[lower, second]

    def _hashes(self, lower: bool, second: bool) -> np.ndarray:
        table, sizes = _TABLES[int(second)], (self.ends - self.starts).astype(np.int32)
        out, at = np.empty(len(sizes), np.uint64), 0
        while at < len(out):
            # some words, and their bytes in a row
            to = max(at + 1, int(np.searchsorted(self.ends, self.starts[at] + _HASH_BYTES, "right")))
            some = self.data[self.starts[at] : self.ends[to - 1]]
            some = some[~_BLANK[some]]
            ends = np.cumsum(sizes[at:to], dtype=np.int32)
            begins = ends - sizes[at:to]
            place = np.arange(len(some), dtype=np.int32) - np.repeat(begins, sizes[at:to])
            np.minimum(place, PLACES - 1, out=place)
            sums = np.zeros(len(some) + 1, np.uint64)
            np.cumsum(table[place << 8 | (_LOWER[some] if lower else some)], out=sums[1:])
            out[at:to] = sums[ends] - sums[begins]
            at = to
        for i in np.flatnonzero(sizes > PLACES):
            word = self.data[self.starts[i] : self.ends[i]]
            digest = blake2b((_LOWER[word] if lower else word).tobytes(), digest_size=16).digest()
            out[i] = np.frombuffer(digest, "<u8")[int(second)]
        return mixed(out)

    def texts_of(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def layout(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary array; a null counts as an empty text."""
    texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    raw = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32) if len(texts) else np.zeros(1, np.int32)
    offsets = raw[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2] if len(texts) else None
    content = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return content, offsets


def split_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    begin, end = int(offsets[0]), int(offsets[-1])
    data, offsets = data[begin:end], offsets - begin
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_BLANK[data]
    edge = np.diff(inside)
    starts, ends = edge[:-1] == 1, edge[1:] == -1
    # a border between texts also ends a word
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    cuts = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]
    starts[cuts] = True
    ends[cuts - 1] = True
    first = np.flatnonzero(starts)
    return Words(data, first, np.flatnonzero(ends) + 1, np.searchsorted(first, offsets))


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """Words of runs of texts of about ``most`` bytes, one text at least: (first text, text after the last, words)."""
    data, offsets = layout(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, to, split_words(data, offsets[at : to + 1])
        at = to


def longer(hashes: np.ndarray, length: int, to: int) -> np.ndarray:
    """Hashes of runs of ``to`` words from those of ``length`` words, ``length <= to <= 2 * length``."""
    if length == to:
        return hashes
    shift = to - length
    if len(hashes) <= shift:
        return np.zeros(0, np.uint64)
    # the length goes in, so that runs of different lengths do not meet
    return mixed(hashes[:-shift] * np.uint64(0xD6E8FEB86659FD93) + (hashes[shift:] ^ np.uint64(to * 0x9E3779B9)))


def runs_of(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` words, by doubling."""
    if length == 1:
        return hashes
    half = (length + 1) // 2
    return longer(runs_of(hashes, half), half, length)


def starts_inside(bounds: np.ndarray, length: int, total: int) -> np.ndarray:
    """Which of the first ``total - length + 1`` words start a run that stays inside its text."""
    last = max(0, total - length + 1)
    left = np.repeat(bounds[1:], np.diff(bounds))[:last] - np.arange(last)
    return left >= length


def windowed(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over each ``width`` neighbours, by doubling."""
    reach, out = 1, values
    while reach * 2 <= width:
        out = pick(out[:-reach], out[reach:]) if len(out) > reach else out[:0]
        reach *= 2
    rest = width - reach
    return (pick(out[:-rest], out[rest:]) if len(out) > rest else out[:0]) if rest else out
