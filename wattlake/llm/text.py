"""Words and their 64-bit hashes for whole batches of texts, as numpy arrays.

A word is a maximal run of bytes other than the six ASCII white-space bytes (0x20, 0x09-0x0D).
Since these bytes never occur inside a multi-byte UTF-8 character, words of bytes are words of
code points. Lower case means A-Z to a-z only.

The hash of a word is a polynomial in an odd base modulo 2**64 over random byte values, mixed at
the end. Two different words share a hash with a chance of about 2**-55; where a contract asks for
exactness, hashes of whole sets are only compared after this tiny chance, never truncated further.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(
    1, 2**64, size=256, dtype=np.uint64
)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, size: int) -> np.ndarray:
    """base**0 ... base**(size-1) modulo 2**64, kept for the worker and doubled when too short."""
    table = _powers.get(base, np.ones(1, np.uint64))
    while len(table) < size:
        step = np.uint64(pow(base, len(table), 2**64))
        table = np.concatenate([table, table * step])
    if len(table) <= 4 * CHUNK_BYTES:
        _powers[base] = table
    return table[:size]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """The words of some texts, in order.

    data: bytes of all texts, each followed by one newline byte. start, end: byte positions of
    each word. first: for each text the number of its first word, with the total at the end.
    hashes: of each word. text_start: byte position of each text, with the total at the end.
    sums: prefix sums from which hashes_of() makes the hash of any stretch of bytes.
    """

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hashes: np.ndarray
    text_start: np.ndarray
    sums: np.ndarray

    def hashes_of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the stretches start <= byte < end."""
        back = _power_table(_INVERSE, len(self.data) + 1)
        return mix((self.sums[end] - self.sums[start]) * back[start])


def words_of(texts: list[bytes], lower: bool) -> Words:
    """Words of UTF-8 texts. No texts or texts without words give empty arrays."""
    joined = b"\n".join([*texts, b""])
    if lower:
        joined = joined.lower()
    data = np.frombuffer(joined, np.uint8)
    text_start = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=text_start[1:])
    inside = np.zeros(len(data) + 1, np.int8)
    inside[:-1] = ~_SPACE[data]
    edge = np.diff(inside, prepend=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    first = np.searchsorted(start, text_start)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * _power_table(_BASE, len(data)), out=sums[1:])
    words = Words(data, start, end, first, np.zeros(0, np.uint64), text_start, sums)
    words.hashes = words.hashes_of(start, end)
    return words


def combine(*parts: np.ndarray) -> np.ndarray:
    """One hash of several hashes, in their order."""
    out = np.zeros_like(parts[0])
    for i, part in enumerate(parts):
        out = mix(out * np.uint64(_BASE) + part + np.uint64(i + 1))
    return out


def chunks(batch: pa.RecordBatch | pa.Table, column: str = "text") -> Iterator[tuple[slice, list[bytes]]]:
    """Slices of a batch with their texts as bytes (null: empty), at most CHUNK_BYTES or one row."""
    texts = batch.column(column).cast(pa.large_binary()).to_pylist()
    begin = size = 0
    for i, text in enumerate(texts):
        n = len(text or b"")
        if size and size + n > CHUNK_BYTES:
            yield slice(begin, i), [t or b"" for t in texts[begin:i]]
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield slice(begin, len(texts)), [t or b"" for t in texts[begin:]]
