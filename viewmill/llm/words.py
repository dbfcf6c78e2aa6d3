"""Words and word windows of many texts at once, as arrays over their UTF-8 bytes.

Words are runs of bytes other than space and \\t \\n \\v \\f \\r. A batch of texts is cut into groups of at most
``GROUP_BYTES`` (a longer text is a group of its own), so that memory follows the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

GROUP_BYTES = 1 << 20
#: Words of more bytes are hashed one by one: sums of powers are equal for some long words of two letters.
LONG_WORD = 32
_U = np.uint64
_BYTE_FACTOR, _WORD_FACTOR = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)


def _inverse(odd: np.uint64) -> np.uint64:
    """Of an odd number modulo 2^64."""
    return _U(pow(int(odd), -1, 1 << 64))


def powers(factor: np.uint64, n: int) -> np.ndarray:
    """factor^0 .. factor^(n-1) modulo 2^64."""
    steps = np.full(max(n, 1), factor, dtype=_U)
    steps[0] = 1
    return np.multiply.accumulate(steps)[:n]


def mix(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread the bits of 64-bit values; other salts give other, unrelated values."""
    x = values + _U((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def slice_hashes(items: np.ndarray, starts: np.ndarray, ends: np.ndarray, factor: np.uint64) -> np.ndarray:
    """A hash of items[start:end] for each pair, from differences of one running sum."""
    n = len(items)
    sums = np.zeros(n + 1, dtype=_U)
    np.cumsum(items.astype(_U) * powers(factor, n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(_inverse(factor), n + 1)[starts])


@dataclass
class Words:
    """Words of one group of texts. Texts are ``first``, ``first + 1``, … of the batch."""

    data: np.ndarray  # bytes of the group
    first: int
    bounds: np.ndarray  # words of text i are bounds[i]:bounds[i + 1]
    starts: np.ndarray  # byte positions of words within data
    ends: np.ndarray
    offsets: np.ndarray  # byte positions between texts
    hashes: np.ndarray | None = None

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of ``size`` words that lie within one text, and the text bounds among them."""
        counts = np.maximum(np.diff(self.bounds) - size + 1, 0)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        skipped = np.repeat(self.bounds[:-1] - bounds[:-1], counts)
        first = np.arange(bounds[-1]) + skipped
        return slice_hashes(self.hashes, first, first + size, _WORD_FACTOR), bounds


def _spaces(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data - np.uint8(9)) <= 4)


def _words(data: np.ndarray, offsets: np.ndarray, first: int, hashed: bool) -> Words:
    inside = ~_spaces(data)
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) & ~edge[:-1]
    starts = np.flatnonzero(inside & ~before)
    after = np.concatenate([inside[1:], [False]]) & ~edge[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    bounds = np.searchsorted(starts, offsets)
    hashes = slice_hashes(data, starts, ends, _BYTE_FACTOR) if hashed else None
    if hashed:
        for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
            hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    return Words(data, first, bounds, starts, ends, offsets, hashes)


def lowered(data: np.ndarray) -> np.ndarray:
    """A copy with A-Z, and nothing else, in lower case."""
    return np.where((data - np.uint8(65)) <= 25, data + np.uint8(32), data)


def word_groups(texts: pa.Array, lower: bool = False, hashed: bool = True) -> Iterator[Words]:
    """All texts of an Arrow array, group by group; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    everything = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + GROUP_BYTES, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        data = everything[offsets[first] : offsets[last]]
        yield _words(lowered(data) if lower else data, offsets[first : last + 1] - offsets[first], first, hashed)
        first = last


def repeated(values: np.ndarray) -> np.ndarray:
    """For each value, whether it is there more than once."""
    if len(values) < 2:
        return np.zeros(len(values), dtype=bool)
    ordered = np.sort(values)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(twice) == 0:
        return np.zeros(len(values), dtype=bool)
    return twice[np.minimum(np.searchsorted(twice, values), len(twice) - 1)] == values


def covered(starts: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """For each of n places, whether it lies in one of the spans start, start + 1, … of the given lengths."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.subtract.at(change, np.minimum(starts + lengths, n), 1)
    return np.cumsum(change[:-1]) > 0


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for group in word_groups(texts, lower=True):
        values, among = group.windows(size)
        for i in range(len(group.bounds) - 1):
            found = values[among[i] : among[i + 1]]
            if len(found) == 0 and group.bounds[i + 1] > group.bounds[i]:
                # Fewer words than a shingle has: the whole sequence is one, kept apart by its length.
                n = group.bounds[i + 1] - group.bounds[i]
                words = group.hashes[group.bounds[i] : group.bounds[i + 1]]
                with np.errstate(over="ignore"):
                    value = np.uint64(n)
                    for w in words:
                        value = mix(np.array([value * np.uint64(31) + w], dtype=np.uint64), int(n))[0]
                found = np.array([value], dtype=np.uint64)
            yield np.unique(found)
