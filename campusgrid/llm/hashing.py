"""Words of many texts at once, as 64-bit fingerprints in numpy arrays.

The functions work on the byte buffer of an Arrow string column, so no Python
object is made per word. Fingerprints depend on the bytes alone: every task and
every run gives the same ones. Two different words share one with a chance of
about 2**-60.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text whose words are held at a time; the arrays made of them take some forty times as much.
CHUNK_BYTES = 500_000
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits spread over the whole word (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_table(keep: bytes) -> np.ndarray:
    """True for the byte values that belong to words."""
    table = np.zeros(256, dtype=bool)
    table[list(keep)] = True
    return table


#: Words between ASCII blanks: [^\x20\x09-\x0D]+
BLANK_SEPARATED = byte_table(bytes(b for b in range(256) if b != 32 and not 9 <= b <= 13))
#: Words of ASCII letters, digits and every character beyond ASCII.
ALPHANUMERIC = byte_table(
    bytes(b for b in range(256) if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 or 65 <= b <= 90)
)


class _Powers:
    """Powers of the base and of its inverse, grown as longer texts come."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK_BYTES + 1)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                powers = np.full(size, base, dtype=np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))
        return self.up[:n], self.down[:n]


@dataclass
class Words:
    """The words of consecutive texts.

    Word i is data[starts[i]:ends[i]]; text t has the words first[t] to first[t + 1].
    """

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint of the `size` words from each word on, and whether one text holds them."""
        count = max(0, len(self.hashes) - size + 1)
        found = np.zeros(count, dtype=np.uint64)
        for j in range(size):
            found = found * _STEP + self.hashes[j : j + count]
        inside = np.arange(count) + size <= self.first[1:][self.owner[:count]]
        return mixed(found), inside


def chunks(column: pa.Array, folded: bool, word_bytes: np.ndarray) -> Iterator[tuple[int, Words]]:
    """The texts of an Arrow column (null: no words), some megabytes at a time.

    folded: A-Z count as a-z. Yields the index of the first text and the words.
    """
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    raw = np.frombuffer(buffer, dtype=np.uint8) if buffer else np.zeros(0, dtype=np.uint8)
    fold = np.arange(256, dtype=np.uint8)
    if folded:
        fold[65:91] += 32
    values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    powers = _Powers()
    begin = 0
    while begin < len(column):
        limit = np.searchsorted(offsets, offsets[begin] + CHUNK_BYTES, side="right") - 1
        end = min(len(column), max(begin + 1, int(limit)))
        data = fold[raw[offsets[begin] : offsets[end]]]
        yield begin, _words(data, offsets[begin : end + 1] - offsets[begin], word_bytes, values, powers)
        begin = end


def _words(data, offsets, word_bytes, values, powers) -> Words:
    inside = word_bytes[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside
    before[offsets] = False
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = inside
    after[offsets] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    up, down = powers.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * up[: len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    hashes = mixed(hashes + (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    return Words(data, starts, ends, np.searchsorted(starts, offsets), hashes)


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's bigint."""
    return x.view(np.int64)
