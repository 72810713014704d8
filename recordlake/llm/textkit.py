"""Vectorised work on the texts of one Arrow batch: words, hashes of words and of runs of words.

A word is a run of bytes other than space and the five control characters 0x09 to 0x0D. All
functions take the bytes of many texts at once and use numpy over the whole buffer, so nothing
runs for each row or each word in Python. Hashes are 64 bits wide and depend on the text alone
(fixed seeds), so that they agree on all executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is handled alone.
CHUNK = 1 << 18
#: Bytes whose words are hashed at once; a longer word is hashed alone.
STEP = 1 << 16
#: Texts handled at once.
ROWS = 256

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUE = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
VALUE_LOWER = _VALUE.copy()
VALUE_LOWER[65:91] = _VALUE[97:123]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    out = []
    for base in (_BASE, _INVERSE):
        steps = np.full(n, base, dtype=np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


_POWERS = _powers(STEP)


@dataclass
class Texts:
    """The UTF-8 bytes of some texts, one after the other; text i is data[at[i]:at[i + 1]]."""

    data: np.ndarray
    at: np.ndarray
    first: int

    def __len__(self) -> int:
        return len(self.at) - 1

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.at[i]:self.at[i + 1]].tobytes()


def texts_of(column: pa.Array, rows: int = ROWS, chunk: int = CHUNK) -> Iterator[Texts]:
    """The texts of an Arrow column in groups of bounded bytes and rows; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    at = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(at, at[i] + chunk, side="right")) - 1
        j = min(max(j, i + 1), i + rows, n)
        yield Texts(data[at[i]:at[j]], at[i:j + 1] - at[i], i)
        i = j


@dataclass
class Words:
    """Words in text order: byte span [start, end), hash, the text each is of, and words before each text."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    text: np.ndarray
    before: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.before)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, values: np.ndarray = _VALUE) -> np.ndarray:
    """A hash of each byte span; spans ascend and don't overlap."""
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + STEP, side="right")))
        lo, hi = int(start[i]), int(end[j - 1])
        up, down = _POWERS if hi - lo <= STEP else _powers(hi - lo)
        total = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum(values[data[lo:hi]] * up[:hi - lo], out=total[1:])
        out[i:j] = (total[end[i:j] - lo] - total[start[i:j] - lo]) * down[start[i:j] - lo]
        i = j
    return mix(out)


def words_of(texts: Texts, lower: bool = False) -> Words:
    """Words of all texts; ``lower`` hashes A-Z as a-z."""
    data, at = texts.data, texts.at
    inside = ~_SPACE[data]
    n = len(data)
    if not n:
        z = np.zeros(0, dtype=np.int64)
        return Words(z, z, np.zeros(0, dtype=np.uint64), z, np.zeros(len(at), dtype=np.int64))
    edge = np.zeros(n + 1, dtype=bool)
    edge[at] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    before = np.searchsorted(start, at)
    text = np.repeat(np.arange(len(at) - 1), np.diff(before))
    return Words(start, end, span_hashes(data, start, end, VALUE_LOWER if lower else _VALUE), text, before)


def runs(words: Words, k: int) -> np.ndarray:
    """Hash of the k words from each word on; garbage where the run leaves the array or its text."""
    h = words.hash
    n = len(h)
    out = np.zeros(n, dtype=np.uint64)
    m = max(0, n - k + 1)
    if m:
        # doubling: the hash of 2w words from two hashes of w words
        power, width, done = h.copy(), 1, 0
        acc = np.zeros(n, dtype=np.uint64)
        step = _STEP
        bits = k
        while bits:
            if bits & 1:
                shifted = np.zeros(n, dtype=np.uint64)
                shifted[:n - done] = power[done:] if done else power
                factor = np.uint64(pow(int(_STEP), done, 1 << 64))
                acc = acc + shifted * factor
                done += width
            bits >>= 1
            if bits:
                nxt = np.zeros(n, dtype=np.uint64)
                if n > width:
                    nxt[:n - width] = power[width:]
                power = power + nxt * step
                step = np.uint64(pow(int(step), 2, 1 << 64))
                width *= 2
        out = mix(acc ^ np.uint64(k))
    return out


def whole_runs(words: Words, k: int) -> np.ndarray:
    """Positions of words from which k words follow in the same text."""
    n = len(words.hash)
    if n < k:
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(words.text[:n - k + 1] == words.text[k - 1:])


def shingle_sets(words: Words, k: int, bits: int = 56) -> tuple[np.ndarray, np.ndarray]:
    """The distinct k-word shingles of each text: hashes, ascending in each text, and offsets.

    A text of fewer than k words has one shingle, the whole sequence; one without words has none.
    At most 256 texts at once: 56 bits of the hash and the number of the text are sorted together.
    """
    assert len(words.before) <= 257
    pos = whole_runs(words, k)
    parts, owners = [runs(words, k)[pos]], [words.text[pos]]
    count = words.counts()
    for short in np.unique(count[(count > 0) & (count < k)]):
        which = np.flatnonzero(count == short)
        parts.append(runs(words, int(short))[words.before[which]])
        owners.append(which)
    h, owner = np.concatenate(parts), np.concatenate(owners).astype(np.uint64)
    key = np.sort((owner << np.uint64(bits)) | (h >> np.uint64(64 - bits)))
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    at = np.searchsorted(key, np.arange(len(count) + 1, dtype=np.uint64) << np.uint64(bits))
    if len(count) == 256:  # 256 << 56 wraps around
        at[-1] = len(key)
    return key & np.uint64((1 << bits) - 1), at
