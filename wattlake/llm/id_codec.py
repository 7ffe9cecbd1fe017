"""Adaptive context-mixing range coder for token ids, in blocks that stand alone.

A block's ids are dealt to interleaved lanes, each a run of consecutive ids with a range coder of
its own; one step codes one id of every lane, so a step is array work. All lanes share one model
that starts empty in every block and learns from each step:

* order 0: adaptive frequencies of all ids, renewed every few steps;
* order 1 and order 2: the id last seen after the previous one and after the previous two, with
  a count of how often it has held.

The three are mixed into one distribution: the order-0 frequencies plus a mass on each predicted
id, which follows the measured odds that such a prediction holds. Encoder and decoder run the
same steps, so they always hold the same model. A checksum of the ids ends every block.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"IDC1"
MOST_LANES = 4096
LEAST_STEPS = 64
STEPS_PER_RENEWAL = 16
TOTAL = 1 << 17
CONTEXT_BITS = 18
CONFIDENCE = 4

#: No prediction: shifts to id -1, and its confidence is the last row of the masses, which is 0.
_NONE = -8 + CONFIDENCE
#: Confidence after a prediction that failed or held, by 2 * confidence + held.
_NEXT_TRUST = np.array([0, 1, 0, 2, 0, 3, 0, 3, 0, 0])

_U = np.uint64
_TOP, _BOTTOM = _U(1 << 48), _U(1 << 32)
_WORD = _U(16)
_HEADER = struct.Struct("<4sIIIHI")


class _Model:
    """next_1 and next_2 hold 8 * id + confidence for each context, or _NONE.

    A step's distribution is laid out as the order-0 intervals of all ids, then the mass of the
    order-1 prediction, then that of the order-2 prediction.
    """

    def __init__(self, alphabet: int, lanes: int) -> None:
        self.alphabet = alphabet
        self.counts = np.zeros(alphabet, np.int64)
        self.fresh: list[np.ndarray] = []
        self.next_1 = np.full(alphabet + 1, _NONE, np.int64)
        self.next_2 = np.full(1 << CONTEXT_BITS, _NONE, np.int64)
        # Predictions that failed and held, for each order and confidence, with a weak start.
        self.seen = np.array([[[3.0, 1.0]] * CONFIDENCE] * 2)
        self.last = np.full(lanes, alphabet, np.int64)
        self.before = np.full(lanes, alphabet, np.int64)
        self.renew()

    def renew(self) -> None:
        """Order-0 frequencies (at least 1 each) and the mass of a prediction, from all seen ids."""
        if self.fresh:
            self.counts += np.bincount(np.concatenate(self.fresh), minlength=self.alphabet)
            self.fresh.clear()
        spare = TOTAL - self.alphabet
        seen = max(int(self.counts.sum()), 1)
        self.size = (self.counts * (spare / seen)).astype(np.int64) + 1
        end = np.cumsum(self.size)
        self.begin = end - self.size
        self.total = int(end[-1])
        self.inverse: np.ndarray | None = None
        odds = self.seen[..., 1] / np.maximum(self.seen[..., 0], 0.05)
        self.mass = np.zeros((2, CONFIDENCE + 1), np.int64)
        self.mass[:, :CONFIDENCE] = np.clip(odds * self.total, 1, TOTAL << 5)

    def predict(self, n: int) -> None:
        """Predicted ids of the first n lanes and their masses; no prediction has no mass."""
        self.context_1 = self.last[:n]
        self.context_2 = (
            (self.before[:n] * 0x9E3779B1 + self.context_1 * 0x85EBCA6B) >> 7
        ) & ((1 << CONTEXT_BITS) - 1)
        entry_1, entry_2 = self.next_1[self.context_1], self.next_2[self.context_2]
        self.guess_1, self.guess_2 = entry_1 >> 3, entry_2 >> 3
        self.trust_1, self.trust_2 = entry_1 & 7, entry_2 & 7
        self.mass_1, self.mass_2 = self.mass[0][self.trust_1], self.mass[1][self.trust_2]
        self.sum = self.mass_1 + self.mass_2 + self.total

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size for each id: the larger prediction that holds, else order 0."""
        self.held_1, self.held_2 = self.guess_1 == ids, self.guess_2 == ids
        start, size = self.begin[ids], self.size[ids]
        first = self.held_1 & (self.mass_1 >= self.mass_2 * self.held_2)
        second = self.held_2 & ~first
        np.copyto(start, self.total, where=first)
        np.copyto(size, self.mass_1, where=first)
        np.copyto(start, self.mass_1 + self.total, where=second)
        np.copyto(size, self.mass_2, where=second)
        return start, size

    def find(self, target: np.ndarray) -> np.ndarray:
        """Ids whose interval holds the target values."""
        if self.inverse is None:
            self.inverse = np.repeat(np.arange(self.alphabet), self.size)
        ids = self.inverse[np.minimum(target, self.total - 1)]
        np.copyto(ids, self.guess_1, where=target >= self.total)
        np.copyto(ids, self.guess_2, where=target >= self.mass_1 + self.total)
        return ids

    def learn(self, ids: np.ndarray) -> None:
        """Count the step and let each context remember its id; call after interval(ids)."""
        n = len(ids)
        shifted = ids << 3
        for order, trust, held, table, key in (
            (0, self.trust_1, self.held_1, self.next_1, self.context_1),
            (1, self.trust_2, self.held_2, self.next_2, self.context_2),
        ):
            code = trust * 2 + held
            tally = np.bincount(code, minlength=2 * CONFIDENCE + 2)
            self.seen[order] += tally[: 2 * CONFIDENCE].reshape(CONFIDENCE, 2)
            table[key] = shifted + _NEXT_TRUST[code]
        self.fresh.append(ids)
        self.before[:n] = self.last[:n]
        self.last[:n] = ids


def _shape(n: int) -> tuple[int, int]:
    """Lanes, and steps of the first lane."""
    lanes = max(1, min(MOST_LANES, n // LEAST_STEPS))
    return lanes, -(-n // lanes)


def _grid(n: int, lanes: int, steps: int) -> list[int]:
    """Active lanes in each step: all but the last lanes are full."""
    return [lanes if (lanes - 1) * steps + t < n else -(-(n - t) // steps) for t in range(steps)]


def encode(ids: np.ndarray) -> bytes:
    """A block of ids (non-negative, below 2**16)."""
    n = len(ids)
    check = zlib.crc32(ids.astype("<u4").tobytes())
    if not n:
        return _HEADER.pack(MAGIC, 0, 0, 0, 0, check)
    alphabet = int(ids.max()) + 1
    if alphabet > 1 << 16:
        raise ValueError("ids have to be below 65536")
    lanes, steps = _shape(n)
    table = np.zeros(lanes * steps, np.int64)
    table[:n] = ids
    table = table.reshape(lanes, steps).T.copy()
    model = _Model(alphabet, lanes)
    low, span = np.zeros(lanes, _U), np.full(lanes, 2**64 - 1, _U)
    out = np.zeros((lanes, 3 * steps + 8), "<u2")
    used = np.zeros(lanes, np.int64)
    every = np.arange(lanes)
    for t, active in enumerate(_grid(n, lanes, steps)):
        if t and t % STEPS_PER_RENEWAL == 0:
            model.renew()
        now = table[t, :active]
        model.predict(active)
        start, size = model.interval(now)
        a, b = low[:active], span[:active]
        unit = b // model.sum.astype(_U)
        a = a + unit * start.astype(_U)
        b = unit * size.astype(_U)
        lane = np.flatnonzero(_to_move(a, b))
        while len(lane):
            x, y = a[lane], b[lane]
            at = used[lane]
            out[lane, at] = x >> _TOP_SHIFT
            used[lane] = at + 1
            x <<= _WORD
            y <<= _WORD
            again = _to_move(x, y)
            a[lane], b[lane] = x, y
            lane = lane[again]
        low[:active], span[:active] = a, b
        model.learn(now)
    for _ in range(4):
        out[every, used] = low >> _TOP_SHIFT
        used += 1
        low <<= _WORD
    streams = b"".join(out[i, : used[i]].tobytes() for i in range(lanes))
    head = _HEADER.pack(MAGIC, n, alphabet, len(streams), lanes, check)
    return head + used.astype("<u4").tobytes() + streams


_TOP_SHIFT = _U(48)


def _to_move(low: np.ndarray, span: np.ndarray) -> np.ndarray:
    """Lanes whose upper word is settled; a lane about to run out of range gives up its tail."""
    settled = (low ^ (low + span)) < _TOP
    short = ~settled & (span < _BOTTOM)
    if short.any():
        span[short] = (~low[short] + _U(1)) & (_BOTTOM - _U(1))
    return settled | short


def decode(block: bytes) -> np.ndarray:
    """Ids of a block; a damaged block raises ValueError."""
    magic, n, alphabet, size, lanes, check = _HEADER.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a block of ids")
    ids = np.zeros(0, np.int64)
    if n:
        used = np.frombuffer(block, "<u4", lanes, _HEADER.size).astype(np.int64)
        words = np.frombuffer(block, "<u2", size // 2, _HEADER.size + 4 * lanes)
        ids = _decode(words, used, n, alphabet, lanes)
    if zlib.crc32(ids.astype("<u4").tobytes()) != check:
        raise ValueError("checksum of a block of ids does not match")
    return ids


def _decode(words: np.ndarray, used: np.ndarray, n: int, alphabet: int, lanes: int) -> np.ndarray:
    steps = -(-n // lanes)
    at = np.cumsum(used) - used
    end = np.int64(len(words) - 1)
    low, span, code = np.zeros(lanes, _U), np.full(lanes, 2**64 - 1, _U), np.zeros(lanes, _U)
    for _ in range(4):
        code = (code << _WORD) | words[np.minimum(at, end)]
        at += 1
    model = _Model(alphabet, lanes)
    table = np.zeros((steps, lanes), np.int64)
    for t, active in enumerate(_grid(n, lanes, steps)):
        if t and t % STEPS_PER_RENEWAL == 0:
            model.renew()
        model.predict(active)
        a, b, c = low[:active], span[:active], code[:active]
        unit = b // model.sum.astype(_U)
        target = np.minimum(((c - a) // unit).astype(np.int64), model.sum - 1)
        now = model.find(target)
        start, size = model.interval(now)
        a = a + unit * start.astype(_U)
        b = unit * size.astype(_U)
        lane = np.flatnonzero(_to_move(a, b))
        while len(lane):
            x, y, next_word = a[lane], b[lane], at[lane]
            code[lane] = (code[lane] << _WORD) | words[np.minimum(next_word, end)]
            at[lane] = next_word + 1
            x <<= _WORD
            y <<= _WORD
            again = _to_move(x, y)
            a[lane], b[lane] = x, y
            lane = lane[again]
        low[:active], span[:active] = a, b
        table[t, :active] = now
        model.learn(now)
    return table.T.reshape(-1)[:n].copy()
