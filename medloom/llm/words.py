"""Words of a batch of texts as numpy arrays.

A word is a maximal run of bytes other than space and \\t..\\r, so words follow
``[^\\x20\\x09-\\x0D]+`` whatever else a text holds. All functions run in Spark tasks,
on slices of an Arrow batch that hold about SLICE_BYTES of text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
#: Bytes whose words are hashed at once.
BLOCK_BYTES = 1 << 21
WORD = r"[^\x20\x09-\x0D]+"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def _table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of _BASE and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            out = np.ones(1, np.uint64)
            while len(out) < n:
                out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
            _powers[key] = out
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of h over all bits of the result (splitmix64's last steps)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    data: np.ndarray  #: bytes of all texts, one after the other
    text: np.ndarray  #: where each text begins in data; one more at the end
    start: np.ndarray  #: where each word begins in data
    end: np.ndarray
    first: np.ndarray  #: number of the first word of each text; one more at the end

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """Number of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def blocks(self, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
        """Ranges of words that stand in about ``most`` bytes; a longer word is alone."""
        at = 0
        while at < len(self.start):
            stop = max(at + 1, int(np.searchsorted(self.end, self.start[at] + most, "right")))
            yield at, stop
            at = stop

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        out = np.empty(len(self.start), np.uint64)
        for i, j in self.blocks():
            base = self.start[i]
            sums, down = running(self.data[base : self.end[j - 1]])
            start, end = self.start[i:j] - base, self.end[i:j] - base
            out[i:j] = mix((sums[end] - sums[start]) * down[start])
        return out


def running(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of bytes times powers of a base, and the inverse powers: what lies between
    two places, times the inverse power of the first, doesn't depend on where it stands."""
    up, down = _table(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums, down


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes of text each; a longer text is alone."""
    sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]) if len(texts) else []
    begin, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield begin, i
            begin, total = i, 0
        total += int(n)
    if begin < len(texts):
        yield begin, len(texts)


def strings(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """As one array of strings, null being the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    return column.fill_null("")


def words(texts: pa.Array, lower: bool = False) -> Words:
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[at[0] : at[-1]] if buffer is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    at = at - at[0]
    if lower:
        data = _LOWER[data]
    solid = ~_SPACE[data]
    begin, close = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1]
    close[:-1] &= ~solid[1:]
    for mark, edge in ((begin, at[:-1][at[:-1] < at[1:]]), (close, at[1:][at[:-1] < at[1:]] - 1)):
        mark[edge] |= solid[edge]
    start = np.flatnonzero(begin)
    return Words(data, at, start, np.flatnonzero(close) + 1, np.searchsorted(start, at))


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k consecutive entries of h (of len(h) - k + 1 runs)."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    out, have, step = None, 0, h
    size = 1
    while True:
        if k & size:
            part = step[have : have + len(h) - k + 1]
            out = part if out is None else out * np.uint64(0xD6E8FEB86659FD93) + part
            have += size
        if have == k:
            return mix(out + np.uint64(k))
        step = step[: len(step) - size] * np.uint64((0xA0761D6478BD642F * (2 * size + 1)) & ((1 << 64) - 1) | 1) + step[size:]
        size *= 2


def whole_runs(first: np.ndarray, k: int) -> np.ndarray:
    """Of the runs of k words, which ones lie within a single text."""
    n = int(first[-1]) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    ends = np.repeat(first[1:], np.diff(first))[:n]
    return np.arange(n) + k <= ends


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
